"""The near-copy rule on null and repeated ids and on empty texts."""

from cartwheel.llm.near_copies import drop_near_copies

LONG = " ".join(f"word{i}" for i in range(60))
NEAR = LONG.replace("word59", "other")
CLEAN = " ".join(f"clean{i}" for i in range(40))


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    out = drop_near_copies(df)
    assert out.columns == ["doc_id", "text", "extra"]
    return sorted(map(tuple, out.collect()), key=str)


def test_a_shared_id_keeps_its_clean_text(spark):
    assert kept(spark, [(1, LONG, 0), (2, NEAR, 0), (2, CLEAN, 0)]) == sorted([(1, LONG, 0), (2, CLEAN, 0)], key=str)


def test_null_ids_take_part(spark):
    assert kept(spark, [(5, LONG, 0), (None, NEAR, 0), (None, CLEAN, 1)]) == sorted([(5, LONG, 0), (None, CLEAN, 1)], key=str)


def test_empty_texts_stay(spark):
    rows = [(None, "", 0), (None, "", 0), (3, None, 1), (3, " \n", 2), (4, "", 3)]
    assert kept(spark, rows) == sorted(rows, key=str)


def test_repeated_rows_are_one_document(spark):
    assert kept(spark, [(1, LONG, 7), (1, LONG, 3), (0, CLEAN, 1)]) == sorted([(1, LONG, 3), (0, CLEAN, 1)], key=str)
    assert kept(spark, []) == []
