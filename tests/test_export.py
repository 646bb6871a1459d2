"""Bulk requests and changed documents against plain Python."""

import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from pricelens import cli
from pricelens.operators import export as EX

CHANGES = "_index string, _id string, action string, _source string, digest string"


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGES).repartition(3)


def lines_of(index, key, action, source):
    head = json.dumps({action: {"_index": index, "_id": key}}, separators=(",", ":")) + "\n"
    return head + (source + "\n" if action == "index" else "")


@pytest.mark.parametrize("max_bytes,max_documents,digits", [(2000, 1000, 1), (100_000, 3, 1), (4000, 7, 0), (8, 1, 2)])
def test_requests_hold_every_document_once_within_their_bounds(spark, max_bytes, max_documents, digits):
    r = random.Random(1)
    rows = []
    for i in range(400):
        gone = r.random() < 0.2
        source = None if gone else json.dumps({"name": "é" * r.choice([0, 5, 60, 3000 if i % 50 == 0 else 1])}, ensure_ascii=False)
        rows.append(("docs", f"{r.getrandbits(64):016x}", "delete" if gone else "index", source, None if gone else "d"))
    want = {k: lines_of(i, k, a, s) for i, k, a, s, _ in rows}
    got = EX.bulk_requests(changes(spark, rows), max_bytes, max_documents, digits).collect()
    parts, seen = {}, []
    for x in got:
        keys = [target["_id"] for ln in x.body.splitlines() if "name" not in (d := json.loads(ln)) for target in d.values()]
        assert x.body == "".join(want[k] for k in sorted(keys)) and len(keys) == x.n_documents
        seen += keys
        assert x.n_bytes == len(x.body.encode()) and x.n_documents <= max_documents
        assert x.n_bytes <= max_bytes or x.n_documents == 1
        parts.setdefault(x.part, []).append(x.block)
    assert all(sorted(b) == list(range(1, len(b) + 1)) for b in parts.values())
    assert sorted(seen) == sorted(want)
    assert set(parts) == {k[:digits] for k in want}


def test_requests_are_well_filled_and_empty_changes_give_none(spark):
    rows = [("docs", f"{i:04d}", "index", "x" * 20, "d") for i in range(500)]
    size = len(lines_of(*rows[0][:4]).encode())
    got = EX.bulk_requests(changes(spark, rows), 10 * size, 1000, 0).collect()
    assert min(sorted(x.n_documents for x in got)[1:]) >= 8  # all but the last
    assert EX.bulk_requests(changes(spark, []), 100, 10).collect() == []
    with pytest.raises(ValueError):
        EX.bulk_requests(changes(spark, []), 100, 0)


def test_changes_between_runs(spark):
    schema = "commune_code string, commune_name string, department_code string, property_type string, rooms_bucket string, price double, computation_date date"
    base = [("1", "a", "x", "House", "2", 1.5), ("2", "b", "x", "House", "2", 2.5), ("3", None, None, "House", None, 3.5),
            ("4", "d", "x", "House", "2", None)]

    def run(rows, day):
        return EX.keyed_documents(spark.createDataFrame([(*r, None) for r in rows], schema).withColumn(
            "computation_date", F.lit(day).cast("date")), "i")

    first = run(base, "2024-01-01")
    later = run([base[0], ("2", "b", "x", "House", "2", 2.75), base[2], ("5", "e", "x", "House", "2", 9.0)], "2024-01-02")
    got = EX.changed_documents(later, first).collect()
    assert sorted((r.action, json.loads(r._source)["commune_code"] if r._source else None) for r in got) == [
        ("delete", None), ("index", "2"), ("index", "5")]
    assert EX.changed_documents(first, first).count() == 0  # also of documents with NULL keys
    assert run(base + base, "2024-01-01").count() == 4
    assert {r.action for r in EX.changed_documents(first, later.withColumn("_index", F.lit("other"))).collect()} == {"index", "delete"}


def _apply(held, folder):
    for path in sorted(glob.glob(folder + "/requests/part=*/block=*/*.txt")):
        lines = iter(open(path, encoding="utf-8").read().splitlines())
        for head in lines:
            (action, target), = json.loads(head).items()
            if action == "delete":
                del held[target["_id"]]
            else:
                held[target["_id"]] = json.loads(next(lines))
    return held


def test_an_index_kept_by_changes_equals_the_newest_run(spark, tmp_out):
    from pricelens.plans import daily as P
    from tests.conftest import SF_SMALL
    est = P.estimates(spark, SF_SMALL)
    est.write.parquet(tmp_out + "/e1")
    first = spark.read.parquet(tmp_out + "/e1")
    kind = F.col("transaction_count") % 3
    first.filter(kind != 0).withColumn("median_price_m2", F.when(kind == 1, F.col("median_price_m2") + 1).otherwise(F.col("median_price_m2"))).withColumn(
        "computation_date", F.date_add("computation_date", 1)).write.parquet(tmp_out + "/e2")
    n = {k: first.filter(kind == k).count() for k in range(3)}
    one = cli.main(["export", "--estimates", tmp_out + "/e1", "--out", tmp_out + "/x1", "--requests"], spark=spark)
    two = cli.main(["export", "--estimates", tmp_out + "/e2", "--out", tmp_out + "/x2", "--requests", "--previous", tmp_out + "/x1"], spark=spark)
    none = cli.main(["export", "--estimates", tmp_out + "/e2", "--out", tmp_out + "/x3", "--requests", "--previous", tmp_out + "/x2"], spark=spark)
    assert (one["documents"], one["deletions"]) == (100, 0)
    assert (two["documents"], two["deletions"]) == (n[1], n[0]) and none == {"requests": 0, "documents": 0, "deletions": 0}
    held = _apply(_apply({}, tmp_out + "/x1"), tmp_out + "/x2")

    def facts(d):
        return tuple(sorted((k, v) for k, v in d.items() if k != "computation_date"))

    now = spark.read.parquet(tmp_out + "/e2").toPandas().to_dict("records")
    want = {facts({k: v for k, v in r.items() if v is not None and v == v}) for r in now}
    assert {facts(d) for d in held.values()} == want and len(held) == len(now)
