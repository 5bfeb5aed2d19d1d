import hashlib

from pyspark.sql import functions as F

from shelfcast.llm import merkle_audit as m


def pages(spark, n=90):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 7 + 1)) for i in range(n)] + [(None, None, None), (5, "again", ""), (5, "again", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_damage_is_found(spark):
    good = pages(spark)
    bad = good.filter("page_id IS NULL OR page_id <> 17").withColumn("html", F.when(F.col("page_id").isin(3, 40), F.lit("bit rot")).otherwise(F.col("html")))
    bad = bad.union(spark.createDataFrame([(777, "u", "h")], bad.schema))
    got = {(r.page_id, r.status) for r in m.audit(good, bad, range_bytes=300, fan_out=3).collect()}
    assert got == {(3, "changed"), (40, "changed"), (17, "missing"), (777, "extra")}


def test_equal_replicas_and_empty(spark):
    good = pages(spark)
    assert m.audit(good, good.repartition(2)).count() == 0
    none = good.limit(0)
    assert m.audit(none, none).count() == 0
    assert m.audit(none, good).count() == good.count()
    assert {r.status for r in m.audit(good, none).collect()} == {"missing"}


def placed(df, range_bytes=300):
    records = m.record_digests(df)
    return m.manifest(records, m.file_count(records, least_files=2), range_bytes)


def test_tree_is_the_hash_of_its_children(spark):
    wanted = placed(pages(spark))
    rows = sorted(wanted.collect(), key=lambda r: (r.file, r.offset))
    count = max(r.node for r in rows) + 1
    levels = m.merkle_levels(wanted, count, fan_out=3)
    digest = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    nodes = {}
    for r in rows:
        assert r.node == r.offset // 300
        nodes.setdefault((r.file, r.node), []).append(r.digest)
    nodes = {k: digest([digest(v)]) for k, v in nodes.items()}
    for level in levels:
        assert {(r.file, r.node): r.digest for r in level.collect()} == nodes
        up = {}
        for (file, node), d in sorted(nodes.items()):
            up.setdefault((file, node // 3), []).append(d)
        nodes = {k: digest(v) for k, v in up.items()}
    assert {r.node for r in levels[-1].collect()} == {0}


def test_only_differing_branches_are_read(spark):
    good = pages(spark)
    bad = good.withColumn("html", F.when(F.col("page_id") == 33, F.lit("x")).otherwise(F.col("html")))
    wanted = placed(good)
    copy = m.place_by_id(m.record_digests(bad), wanted, 2)
    ranges = m.differing_ranges(m.merkle_levels(wanted, 30, 3), m.merkle_levels(copy, 30, 3), 3).collect()
    where = wanted.filter("page_id = 33").first()
    assert [(r.file, r.node) for r in ranges] == [(where.file, where.node)]


def test_foreign_records_change_the_roots(spark):
    """A replica's tree holds what the primary lacks, each in the range of its id, in front of all others too."""
    good = pages(spark)
    more = spark.createDataFrame([(-4, "u", "h"), (1000, "u", "h"), (33, "u", "zzz")], good.schema)
    wanted = placed(good)
    roots = lambda df: {(r.file, r.digest) for r in m.merkle_levels(m.place_by_id(m.record_digests(df), wanted, 2), 30, 3)[-1].collect()}
    assert not roots(good) & roots(good.union(more))
    assert roots(good) == {(r.file, r.digest) for r in m.merkle_levels(wanted, 30, 3)[-1].collect()}
    got = m.audit(good, good.union(more), range_bytes=300, fan_out=3).collect()
    assert {(r.page_id, r.status, r.file) for r in got if r.page_id != 33} == {(-4, "extra", None), (1000, "extra", None)}
    assert sorted(r.status for r in got if r.page_id == 33) in (["extra"], ["changed", "extra"])
