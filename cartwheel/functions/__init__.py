from cartwheel.functions.semantics import *  # noqa: F401,F403
