import zlib

from shelfcount.llm import interleave as i
from pyspark.sql import functions as F


def check(spark, docs, shards):
    got = [r.asDict() for r in i.interleaved(docs, shards=shards).collect()]
    total = docs.count()
    assert len(got) == total
    sizes = [0] * shards
    for r in got:
        sizes[r["shard"]] += 1
    assert max(sizes) - min(sizes) <= 1
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, k) for s in range(shards) for k in range(sizes[s])]
    return got, sizes


def test_against_one_sort(spark, monkeypatch):
    monkeypatch.setattr(i, "BUCKET_ROWS", 7)
    monkeypatch.setattr(i, "TOP_SLOTS", 4)
    rows = [(k % 90, f"t{k}", f"s{k % 3}" if k % 11 else None) for k in range(200)] + [(None, None, "hot")] * 3 + [(k, "x", "hot") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, _ = check(spark, docs, 16)
    keyed = docs.select(
        "*",
        F.xxhash64(F.lit(42), "doc_id", "text", "source").alias("h1"),
        F.xxhash64(F.lit(43), "doc_id", "text", "source").alias("h2"),
    ).collect()
    order = lambda r: (r.h1, r.doc_id is not None, r.doc_id or 0, r.h2)
    ranked = []
    for source in {r.source for r in keyed}:
        own = sorted((r for r in keyed if r.source == source), key=order)
        ranked += [((k + 0.5) / len(own), "-" if source is None else "+" + source, order(r), r) for k, r in enumerate(own)]
    ranked.sort(key=lambda x: x[:3])
    place = sorted(((g["shard"], g["slot"]), (g["doc_id"], g["text"], g["source"])) for g in got)
    assert [p[1] for p in place] == [(r.doc_id, r.text, r.source) for *_, r in ranked]


def test_every_shard_matches_the_mixture(spark):
    docs = spark.createDataFrame([(k, "t", "hot" if k % 3 == 0 else f"s{k % 5}") for k in range(3200)], "doc_id long, text string, source string")
    got, sizes = check(spark, docs, 16)
    share = {}
    for r in got:
        share.setdefault(r["source"], [0] * 16)[r["shard"]] += 1
    assert all(max(v) - min(v) <= 2 for v in share.values())


def test_digest_and_edges(spark):
    docs = spark.createDataFrame([(1, "é", None, 1), (1, "é", None, 1), (None, None, "a", 2), (3, "", "a", 3)], "doc_id long, text string, source string, shard int")
    got = sorted((r.size, r.text_crc32, r.law, r.grown_shard) for r in i.shard_digest(docs).collect())
    crc = zlib.crc32("é".encode())
    assert got == [(1, 0, "rows", None), (1, 0, "rows", None), (3, crc, "rows", None), (3, crc, "rows", None)]
    assert i.interleaved(docs).columns == ["doc_id", "text", "source", "shard", "slot"]
    assert i.shard_digest(docs.limit(0)).count() == 0


def test_rows_without_an_id_are_dealt_over_the_slots(spark, monkeypatch):
    monkeypatch.setattr(i, "BUCKET_ROWS", 10)
    docs = spark.createDataFrame([(None if k % 2 else 7, f"t{k}", "hot") for k in range(600)], "doc_id long, text string, source string")
    seen = []
    number = i._number

    def spy(df, group, slot, order, name):
        seen.append(df.groupBy(slot.alias("slot")).count().agg(F.max("count")).first()[0])
        return number(df, group, slot, order, name)

    monkeypatch.setattr(i, "_number", spy)
    check(spark, docs, 16)
    assert max(seen) < 40


def test_clashing_names(spark):
    names = "row h1 h2 id rank rank_of at place top n near far __slot __h1".split()
    docs = spark.createDataFrame([(k, "t", "a", *range(len(names))) for k in range(40)], ["doc_id", "text", "source", *names])
    out = i.interleaved(docs)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert sorted(r[:-2] for r in map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))
