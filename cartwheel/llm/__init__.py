"""Training-data operators: quality, language-model scores, near-duplicate
joins, line dedup, source mixing, decontamination, page extraction, chat
rendering, toxicity and nearest neighbours. Nothing else in the library
imports this subpackage."""
