import decimal

from ledgerloom.llm import common, decontaminate, packing


def test_rows_are_kept_beside_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", 5, "x", None), (None, "b", 6, "y", "z"), (2, None, 7, None, None)],
                                 "doc_id long, text string, _listed_code long, _listed_id string, _row_code string")
    gone = docs.filter("doc_id = 1 or doc_id is null").select("doc_id", common.row_code().alias("code"))
    assert [tuple(r) for r in common.keep_rows(docs, gone).collect()] == [(2, None, 7, None, None)]


def test_spans_go_beside_clashing_names(spark):
    item = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, f"say {item} now", 1, "x", 2)], "doc_id long, text string, _hit_id long, _hit_code string, _hit_spans int")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontaminate.decontaminate(docs, items, remove="spans").first()
    assert (row.text, row["_hit_id"], row["_hit_code"], row["_hit_spans"]) == ("say now", 1, "x", 2)


def test_ids_of_any_type_are_packed(spark):
    for kind, ids in (("smallint", [1, 2]), ("decimal(10,2)", [decimal.Decimal("1.50"), None]), ("string", ["a", "b"])):
        docs = spark.createDataFrame([(i, "some words") for i in ids], f"doc_id {kind}, text string")
        assert {r.doc_id for r in packing.pack(docs).collect()} == set(ids)
