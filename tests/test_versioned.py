"""Versioned tables: commits, time travel, changes, clones, evolution."""

import os

import pytest
from pyspark.sql import functions as F

from oreflow.operators import versioned
from oreflow.operators.changes import merge_rows, merge_unmatched
from oreflow.operators.schemas import SchemaMismatch
from oreflow.operators.versioned import VersionedTable


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark, folder):
    df = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, None, 30.0)], "id INT, kind STRING, v DOUBLE")
    return VersionedTable.create(spark, f"{folder}/t", df)


@pytest.fixture
def clustered(spark, folder):
    df = spark.createDataFrame(
        [(i, f"k {i % 3}: x", float(i)) for i in range(30)] + [(99, None, 1.0)], "id INT, kind STRING, v DOUBLE"
    )
    return VersionedTable.create(spark, f"{folder}/c", df, cluster_by="kind")


def test_versions_and_history(table):
    before = rows(table.read())
    table.update({"v": F.col("v") * 2}, F.col("id") == 1)
    table.delete(F.col("id") == 2)
    assert rows(table.read(version=0)) == before
    assert rows(table.read()) == [(1, "a", 20.0), (3, None, 30.0)]
    assert [(r.version, r.operation) for r in table.history().collect()] == [
        (2, "DELETE"), (1, "UPDATE"), (0, "CREATE TABLE AS SELECT")
    ]
    assert rows(table.read(timestamp=table.at(1).committed_at)) == rows(table.read(version=1))
    with pytest.raises(LookupError):
        table.read(version=7)


def test_delete_all_keeps_schema_and_restore_undoes_it(table):
    before = rows(table.read())
    table.delete()
    assert table.read().count() == 0 and table.read().columns == ["id", "kind", "v"]
    table.restore(0)
    assert rows(table.read()) == before
    assert table.latest().version == 2


def test_delete_keeps_rows_with_null_condition(table):
    table.delete(F.col("kind") != "a")
    assert rows(table.read()) == [(1, "a", 10.0), (3, None, 30.0)]


def test_update_keeps_type(table):
    table.update({"id": F.lit("7"), "v": 1}, F.col("kind").isNull())
    assert (7, None, 1.0) in [tuple(r) for r in table.read().collect()]
    assert table.read().schema["id"].dataType.simpleString() == "int"


def test_overwrite_of_a_table_by_its_own_rows(table):
    table.overwrite(table.read().withColumn("v", F.col("v") + 1))
    assert [r[2] for r in rows(table.read().select("id", "kind", "v").fillna("z"))] == [11.0, 21.0, 31.0]


def test_extra_column_fails_then_evolves(table):
    wide = table.read().withColumn("extra", F.lit("x"))
    with pytest.raises(SchemaMismatch):
        table.overwrite(wide)
    with pytest.raises(SchemaMismatch):
        table.append(wide)
    assert table.latest().version == 0
    table.overwrite(wide, merge_schema=True)
    assert table.read().columns == ["id", "kind", "v", "extra"]
    assert table.read(version=0).columns == ["id", "kind", "v"]
    table.append(table.read(version=0))
    assert table.read().filter("extra IS NULL").count() == 3


def test_type_change_fails(table):
    with pytest.raises(SchemaMismatch):
        table.append(table.read().withColumn("id", F.col("id").cast("string")))


def test_append_adds_a_segment_and_copies_nothing(table):
    first = table.latest().segments
    table.append(table.read(version=0))
    assert table.latest().segments[: len(first)] == first and len(table.latest().segments) == 2
    assert table.read().count() == 6


def test_replayed_batch_is_skipped(table, spark):
    table.append(table.read(version=0), batch=("s", 4))
    table.append(table.read(version=0), batch=("s", 4))
    table.append(table.read(version=0), batch=("s", 5))
    assert table.read().count() == 9
    new = spark.createDataFrame([(1, "z", 0.0)], table.read().schema)
    version = table.merge(new, ["id"], batch=("m", 0)).version
    assert table.merge(new, ["id"], batch=("m", 0)).version == version


def test_data_without_history_row_is_invisible(table):
    before = rows(table.read())
    table._write(table.read(), None)  # a commit that died before its history row
    assert rows(table.read()) == before
    table.append(table.read(version=0))
    assert table.read().count() == 6


def test_create_twice(table, spark):
    with pytest.raises(FileExistsError):
        VersionedTable.create(spark, table.path, table.read())
    again = VersionedTable.create(spark, table.path, table.read().limit(0), if_not_exists=True)
    assert again.read().count() == 3
    assert not VersionedTable(spark, table.path + "-none").exists()


def test_clones(table, folder):
    before = rows(table.read())
    deep = table.clone(f"{folder}/deep", version=0)
    shallow = table.clone(f"{folder}/shallow", version=0, shallow=True)
    assert rows(deep.read()) == rows(shallow.read()) == before
    assert deep.has_copied_data() and not shallow.has_copied_data()
    shallow.delete(F.col("id") == 1)
    table.delete()
    assert shallow.has_copied_data()
    assert [r[0] for r in rows(shallow.read().fillna("z"))] == [2, 3]
    assert rows(deep.read()) == before
    assert shallow.history().collect()[-1].parameters["isShallow"] == "true"


def test_clustered_change_rewrites_touched_segments_only(clustered):
    old = set(clustered.latest().segments)
    assert len(old) == 4
    clustered.update({"v": -1.0}, F.col("id") == 4)
    new = set(clustered.latest().segments)
    assert len(old & new) == 3 and len(new) == 4
    clustered.delete(F.col("kind") == "k 0: x")
    assert len(clustered.latest().segments) == 3
    assert clustered.read().count() == 21
    clustered.delete(F.col("id") == 99)
    assert clustered.read().filter("kind IS NULL").count() == 0
    assert clustered.read(version=0).count() == 31


def test_clustered_merge(clustered, spark):
    new = spark.createDataFrame(
        [(4, "k 1: x", 44.0), (500, "new", 5.0)], clustered.read().schema
    )
    kept = set(clustered.latest().segments)
    clustered.merge(new, ["id"])
    assert len(kept & set(clustered.latest().segments)) == 3
    got = {r.id: r.v for r in clustered.read().collect()}
    assert len(got) == 32 and got[4] == 44.0 and got[500] == 5.0
    before = rows(clustered.read().fillna("z"))
    clustered.merge(new, ["id"])  # merging the same rows again changes nothing
    assert rows(clustered.read().fillna("z")) == before


def test_folders_are_compared_without_scheme_and_host():
    from oreflow.operators.versioned import _folder

    same = ["/lake/t/data/ab", "file:/lake/t/data/ab", "file:///lake/t/data/ab/", "hdfs://nn:8020/lake/t/data/ab"]
    assert {_folder(p) for p in same} == {"/lake/t/data/ab"}
    assert _folder("s3a://bucket/t/data/_segment=a b") == "/t/data/_segment=a b"


def test_append_then_partial_rewrite_of_a_table_without_clustering(table):
    table.append(table.read().withColumn("id", F.col("id") + 10))
    first, second = table.latest().segments
    table.update({"v": 0.0}, F.col("id") == 12)
    assert first in table.latest().segments and second not in table.latest().segments
    table.update({"v": 5.0}, F.col("id") == 777)  # meets no row: a version, but nothing written
    assert len(table.latest().segments) == 2 and table.latest().version == 3


def test_a_commit_that_died_does_not_block_the_next(spark, folder):
    table = VersionedTable.create(spark, f"{folder}/t", spark.range(3))
    os.makedirs(f"{folder}/t/history/v0000000001/_temporary/0")
    os.makedirs(f"{folder}/t/pending", exist_ok=True)
    with open(f"{folder}/t/pending/left.json", "w") as f:
        f.write('{"version": 1')
    assert table.append(spark.range(2)).version == 1
    assert table.latest().version == 1 and table.read().count() == 5


def test_two_writers_of_one_version(spark, folder):
    table = VersionedTable.create(spark, f"{folder}/t", spark.range(3))
    old = table.latest()
    table.append(spark.range(2))
    with pytest.raises(Exception, match="already exists"):
        table._next(old, "append", {}, old.schema, list(old.segments))
    assert table.read().count() == 5


def counting_reads(table, monkeypatch):
    seen = []
    whole = VersionedTable._rows

    def rows_of(self, v, segments=None):
        seen.append(segments)
        return whole(self, v, segments)

    monkeypatch.setattr(VersionedTable, "_rows", rows_of)
    return seen


def test_merge_by_the_clustering_key_reads_reachable_segments_once(clustered, spark, monkeypatch):
    schema = clustered.read().schema
    before = clustered.latest().segments
    seen = counting_reads(clustered, monkeypatch)
    clustered.merge(spark.createDataFrame([(4, "k 1: x", 44.0), (500, "k 1: x", 5.0), (501, "new", 6.0), (99, None, 9.0)], schema), ["id", "kind"])
    read = [s for s in seen if s]  # an empty list only asks for the schema
    assert len(read) == 1 and len(read[0]) == 2  # the segments "k 1: x" and NULL
    after = clustered.latest().segments
    assert len(set(before) & set(after)) == 3  # NULL keys match nothing, so that segment stays
    got = sorted(((r.id, r.kind, r.v) for r in clustered.read().collect() if r.id in (4, 99, 500, 501)), key=str)
    assert got == sorted([(4, "k 1: x", 44.0), (99, None, 1.0), (99, None, 9.0), (500, "k 1: x", 5.0), (501, "new", 6.0)], key=str)
    assert clustered.read().count() == 34


def test_merge_that_only_inserts_rewrites_nothing(clustered, spark):
    before = clustered.latest().segments
    clustered.merge(spark.createDataFrame([(700, "k 1: x", 1.0)], clustered.read().schema), ["id", "kind"])
    assert clustered.latest().segments[: len(before)] == before
    clustered.merge(spark.createDataFrame([], clustered.read().schema), ["id", "kind"])
    assert clustered.read().count() == 32


def test_null_safe_merge_by_the_clustering_key(clustered, spark):
    clustered.merge(spark.createDataFrame([(99, None, 9.0)], clustered.read().schema), ["id", "kind"], null_safe=True)
    assert [r.v for r in clustered.read().filter("id = 99").collect()] == [9.0]


def test_marks_of_a_merge_are_not_read(clustered, spark):
    clustered.merge(spark.createDataFrame([(4, "k 1: x", 44.0)], clustered.read().schema), ["id", "kind"])
    assert clustered.read().columns == ["id", "kind", "v"]


def test_change_that_meets_no_row_writes_nothing(table, spark):
    before = table.latest().segments
    table.update({"v": 0.0}, F.col("id") == 777)
    table.delete(F.col("id") == 777)
    table.merge(spark.createDataFrame([], table.read().schema), ["id"])
    assert table.latest().segments == before and table.latest().version == 3


def test_nested_fields_are_refused_then_appended(spark, folder):
    old = spark.createDataFrame([(1, [(10, "a")], {"x": (1,)}), (2, None, None)], "id INT, items ARRAY<STRUCT<n: INT, s: STRING>>, m MAP<STRING, STRUCT<k: INT>>")
    table = VersionedTable.create(spark, f"{folder}/nested", old)
    new = spark.createDataFrame(
        [(3, [("b", 7_000_000_000, (1.5,)), None], {"y": (2, "z")})],
        "id INT, items ARRAY<STRUCT<s: STRING, n: BIGINT, price: STRUCT<net: DOUBLE>>>, m MAP<STRING, STRUCT<k: INT, t: STRING>>",
    )
    with pytest.raises(SchemaMismatch) as refused:
        table.append(new)
    assert str(refused.value) == (
        "items.element.n is bigint, not int; items.element.price is not in the table; m.value.t is not in the table"
    )
    first = table.latest().segments
    table.append(new, merge_schema=True)
    assert table.latest().segments[: len(first)] == first
    got = {r.id: r for r in table.read().collect()}
    assert [tuple(x) for x in got[1]["items"]] == [(10, "a", None)] and got[1].m["x"] == (1, None)
    assert got[2]["items"] is None and got[2].m is None
    assert got[3]["items"][0] == (7_000_000_000, "b", (1.5,)) and got[3]["items"][1] is None and got[3].m["y"] == (2, "z")
    table.append(old)  # narrower rows fit as they are
    assert table.read().count() == 5 and table.read(version=0).schema["items"].dataType.elementType.names == ["n", "s"]
    table.overwrite(table.read().filter("id = 3"))
    assert table.read().count() == 1


def test_wider_types():
    from pyspark.sql.types import _parse_datatype_string as of

    from oreflow.operators.schemas import holds, united

    for wide, narrow in (("bigint", "smallint"), ("double", "float"), ("double", "int"), ("decimal(12,2)", "decimal(10,2)"), ("decimal(10,0)", "int")):
        assert holds(of(wide), of(narrow)) and not holds(of(narrow), of(wide)) and united(of(narrow), of(wide)) == of(wide)
    for a, b in (("double", "bigint"), ("decimal(10,4)", "decimal(10,2)"), ("string", "int"), ("date", "timestamp")):
        assert not holds(of(a), of(b)) and not holds(of(b), of(a))
    with pytest.raises(SchemaMismatch, match="s.x is string, not int"):
        united(of("struct<s: struct<x: int>>"), of("struct<s: struct<x: string>>"))


def shuffles_by_segment(monkeypatch):
    """Notes for every write by segment whether its rows are gathered first."""
    seen, write = [], VersionedTable._write

    def noted(self, rows, cluster_by, gather=True):
        seen.append(gather)
        return write(self, rows, cluster_by, gather)

    monkeypatch.setattr(VersionedTable, "_write", noted)
    return seen


def test_rows_that_lie_together_are_not_shuffled_by_segment(clustered, spark, monkeypatch):
    seen = shuffles_by_segment(monkeypatch)
    clustered.delete(F.col("id") == 4)
    clustered.update({"v": F.col("v") + 1}, F.col("id") == 5)  # does not move rows
    clustered.update({"kind": "one"}, F.col("id") == 6)  # one new segment for each old one
    assert seen == [False, False, False]
    clustered.update({"kind": F.concat(F.lit("to "), F.col("id"))}, F.col("id") < 9)  # many
    assert seen == [False, False, False, True]
    assert {r.kind for r in clustered.read().filter("id < 9 AND id <> 4").collect()} == {f"to {k}" for k in (*range(4), *range(5, 9))}
    before = {tuple(r) for r in clustered.read().collect()}
    clustered.overwrite(clustered.read(), gather=False)
    assert seen[-1] is False and {tuple(r) for r in clustered.read().collect()} == before


def test_merge_gathers_rows_of_many_segments_only(spark, folder, monkeypatch):
    rows = spark.range(60).select("id", F.concat(F.lit("k"), F.col("id") % 30).alias("kind"), F.lit(1.0).alias("v"))
    table = VersionedTable.create(spark, f"{folder}/t", rows, "kind", gather=False)
    assert len(table.latest().segments) == 30
    seen = shuffles_by_segment(monkeypatch)
    table.merge(rows.where("id % 30 < 5").withColumn("v", F.lit(2.0)), ["id", "kind"])
    assert seen == [False, False]
    table.merge(rows.withColumn("v", F.lit(3.0)).union(rows.selectExpr("id + 100", "kind", "9.0D")), ["id", "kind"])
    assert seen == [False, False, True, True]
    assert table.read().groupBy("v").count().orderBy("v").collect() == [(3.0, 60), (9.0, 60)]


def test_merge_does_not_shuffle_source_rows_without_key(spark):
    source = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 3.0), (None, 3.0)], "id INT, v DOUBLE")
    keys = spark.createDataFrame([(1,)], "id INT")
    got = merge_unmatched(source, keys, ["id"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(2, 2.0), (None, 3.0), (None, 3.0)], key=str)
    assert "isnotnull(id" in got._jdf.queryExecution().optimizedPlan().toString()
    assert merge_unmatched(source, keys.union(spark.sql("SELECT CAST(NULL AS INT)")), ["id"], null_safe=True).collect() == [(2, 2.0)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_a_large_merge_goes_by_groups_of_segments(clustered, spark, monkeypatch, null_safe):
    """The same rows as of one merge; each group reads its own segments, and neither source nor shuffles stay."""
    schema = clustered.read().schema
    new = [(4, "k 1: x", 44.0), (5, "k 2: x", 55.0), (500, "k 0: x", 5.0), (501, "new", 6.0), (99, None, 9.0), (None, "k 1: x", 7.0), (None, None, 8.0)]
    source = spark.createDataFrame(new, schema)
    want = sorted(map(tuple, merge_rows(clustered.read(), source, ["id", "kind"], null_safe).collect()), key=str)
    before = clustered.latest().segments
    monkeypatch.setattr(versioned, "GROUP_BYTES", 1)
    monkeypatch.setattr(versioned, "GROUPS", 3)
    seen = counting_reads(clustered, monkeypatch)
    staged = []
    monkeypatch.setattr(versioned, "scratch", lambda spark, name: staged.append(f"{clustered.path}-{name}") or staged[-1])
    clustered.merge(source, ["id", "kind"], null_safe)
    read = [s for s in seen if s]
    assert sorted(map(len, read)) == [1, 1, 2] and sorted(sum(map(list, read), [])) == sorted(before)
    assert sorted(map(tuple, clustered.read().collect()), key=str) == want
    assert len(staged) == 1 and not os.path.exists(staged[0])
    assert len(set(before) & set(clustered.latest().segments)) == (1 if null_safe else 2)  # no row was met in the others


def test_vacuum_deletes_what_only_older_versions_hold(clustered):
    clustered.update({"v": 0.0}, F.col("kind") == "k 1: x")
    before, now = rows(clustered.read().where("kind IS NOT NULL")), set(clustered.latest().segments)
    older = set(clustered.at(0).segments)
    clustered.vacuum()
    assert rows(clustered.read().where("kind IS NOT NULL")) == before
    there = lambda s: os.path.exists(s.removeprefix("file:"))
    assert all(map(there, now)) and older - now and not any(map(there, older - now))
    copy = clustered.clone(f"{clustered.path}-copy", shallow=True)
    copy.update({"v": 1.0})
    copy.vacuum()
    assert all(map(there, now))  # a clone doesn't delete its source's files
