import shutil

import pytest
from loomstead.functions.metadata import with_promoted
from loomstead.operators import reports, writes
from loomstead.schemas import COLLECTION_SCHEMA, MANIFEST_SCHEMA, QUARANTINE_SCHEMA, TRIPLE_SCHEMA
from loomstead.session import nothing, shared_folder, written
from loomstead.sources import dumps, files, tables


@pytest.fixture()
def notes(rows):
    df = rows(
        "id string, document string, metadata string, embedding array<float>",
        ("a", 'line\n"two" é', '{"wing":"w","n":1.0}', [0.1, -2.5e-8, 3.0]),
        ("b", None, "{}", None),
    )
    return with_promoted(df).select(COLLECTION_SCHEMA.names)


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_dump_and_load(spark, notes, tmp_path):
    facts = spark.createDataFrame([("t1", "a", "p", "b", "2025-01-01", None, 1.0, None, None, None, None, None)], TRIPLE_SCHEMA)
    folder = str(tmp_path / "dump")
    dumps.export_tables({"notes": notes, "facts": facts}, folder, created="20260101-000000Z")
    listed = {r["table"]: r for r in dumps.read_manifest(spark, folder).collect()}
    assert (listed["notes"].rows, listed["notes"].vector_columns) == (2, ["embedding"])
    assert listed["facts"].columns == TRIPLE_SCHEMA.names and listed["facts"].vector_columns == []
    assert same(dumps.load_dumped(spark, folder, "notes", COLLECTION_SCHEMA), notes)
    assert same(dumps.load_dumped(spark, folder, "facts", TRIPLE_SCHEMA), facts)


def test_promoted_columns_are_derived_on_loading(spark, notes, tmp_path):
    from pyspark.sql import functions as F

    folder = str(tmp_path / "dump")
    dumps.export_tables({"notes": notes.withColumn("wing", F.lit("stale"))}, folder)
    wings = {r.id: r.wing for r in dumps.load_dumped(spark, folder, "notes", COLLECTION_SCHEMA).collect()}
    assert wings == {"a": "w", "b": None}


def test_binary_and_times(spark, tmp_path):
    import datetime

    df = spark.createDataFrame([(bytearray(b"ok"), datetime.datetime(2025, 1, 2, 3, 4, 5, 123456)), (bytearray(b"\xff!"), None)], "b binary, ts timestamp")
    text = [r.b for r in dumps.export_rows(df).collect()]
    assert text == ["ok", "�!"]
    folder = str(tmp_path / "dump")
    dumps.export_tables({"t": df.limit(1)}, folder)
    assert dumps.load_dumped(spark, folder, "t", df.schema).first().asDict() == df.first().asDict()


def test_dry_run_and_restore(spark, notes, tmp_path):
    folder, roots = str(tmp_path / "dump"), {"notes": str(tmp_path / "notes"), "other": str(tmp_path / "other")}
    dumps.export_tables({"notes": notes, "other": notes.limit(1)}, folder)
    tables.write_snapshot(notes.limit(1), roots["notes"])
    current = {"notes": tables.read_snapshot(spark, roots["notes"], COLLECTION_SCHEMA)[1], "extra": notes}
    plan = {r["table"]: (r.backup_rows, r.current_rows) for r in dumps.dry_run(dumps.read_manifest(spark, folder), current).collect()}
    assert plan == {"notes": (2, 1), "other": (1, None), "extra": (None, 2)}
    assert tables.versions(spark, roots["notes"]) == [0]  # a dry run changes nothing
    schemas = {"notes": COLLECTION_SCHEMA, "other": COLLECTION_SCHEMA}
    assert dumps.restore(spark, folder, schemas, roots, table="notes") == {"notes": 1}
    version, restored = tables.read_snapshot(spark, roots["notes"], COLLECTION_SCHEMA)
    assert version == 1 and same(restored, notes)
    assert tables.versions(spark, roots["other"]) == []
    _, before = tables.read_snapshot(spark, roots["notes"], COLLECTION_SCHEMA, before=1)
    assert before.count() == 1


def test_unfinished_snapshots_are_not_read(spark, notes, tmp_path):
    root = str(tmp_path / "s")
    assert tables.read_snapshot(spark, root, COLLECTION_SCHEMA)[0] is None
    tables.write_snapshot(notes, root)
    (tmp_path / "s" / "v=0000000001").mkdir()
    assert tables.versions(spark, root) == [0]


def test_bucketed_upsert_leaves_the_table_in_place(spark, notes, rows):
    tables.save_bucketed(notes, "notes_by_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = rows("id string, document string", ("b", "new"))
        out = writes.upsert(spark.table("notes_by_id"), batch)
        plan = out._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("LeftAnti"):]
        stored = join[: join.index("FileScan")]
        assert "Exchange" not in stored
        assert {r.id: r.document for r in out.collect()}["b"] == "new"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE notes_by_id")


def test_shared_folder_follows_the_session(spark, notes):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(root)
    assert same(written(notes), notes)
    assert root in written(notes).inputFiles()[0]


def test_nothing_is_planned_away(spark):
    plan = nothing(spark, TRIPLE_SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation <empty>")


def test_discover(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name in ("a.jsonl", "deep/b.jsonl", "c.txt"):
        (tmp_path / "in" / name).write_text("{}")
    found = files.discover(spark, str(tmp_path / "in"), nothing(spark, MANIFEST_SCHEMA))
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == ["a.jsonl", "b.jsonl"]
    assert {r.status for r in found.collect()} == {"pending"}
    again = files.discover(spark, str(tmp_path / "in"), found.filter("path LIKE '%a.jsonl'"))
    assert [r.path.rsplit("/", 1)[1] for r in again.collect()] == ["b.jsonl"]


def test_manifest_keeps_done(rows):
    import datetime

    day = datetime.datetime
    entries = rows(
        MANIFEST_SCHEMA, ("a", "done", 1.0, 5, day(2025, 1, 1)), ("a", "pending", 1.0, None, day(2025, 2, 1)),
        ("b", "pending", 1.0, None, None),
    )
    assert {r.path: (r.status, r.drawers) for r in files.current_manifest(entries).collect()} == {
        "a": ("done", 5), "b": ("pending", None)}


def test_quarantine_file(spark, rows, tmp_path):
    path = str(tmp_path / "q")
    batch = rows("id string, document string, metadata string", ("a", "x", "bad"), ("b", "y", "{}"))
    for _ in range(2):
        files.record_skips(writes.split_valid(batch, 3, "notes")[1], path)
    stored = files.read_quarantine(spark, path)
    assert stored.schema == QUARANTINE_SCHEMA and stored.count() == 2
    assert reports.quarantine_counts(stored).first().skipped == 2
    missing = reports.remine_candidates(stored, rows("id string", ("b",))).collect()
    assert [(r.id, r.attempts) for r in missing] == [("a", 2)]
    assert reports.remine_candidates(stored, rows("id string", ("a",))).count() == 0


def test_restore_checks_what_it_loads(spark, notes, tmp_path):
    folder, roots = tmp_path / "dump", {"notes": str(tmp_path / "notes")}
    dumps.export_tables({"notes": notes}, str(folder))
    schemas = {"notes": COLLECTION_SCHEMA}

    def damaged(change):
        copy = tmp_path / f"copy-{change.__name__}"
        shutil.copytree(folder, copy)
        part = max((copy / "notes").glob("part-*"), key=lambda f: f.stat().st_size)
        part.write_text(change(part.read_text()))
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
        return str(copy)

    def last_line_cut(text):
        return text[: len(text) - 9]

    def line_lost(text):
        return "".join(text.splitlines(True)[1:])

    def letter_changed(text):
        at = text.index('"document":"') + 12
        return text[:at] + "#" + text[at + 1 :]

    def lines_turned(text):
        return "".join(reversed(text.splitlines(True)))

    for change, why in ((last_line_cut, "Malformed|FAILFAST|rows in the dump"), (line_lost, "rows in the dump"), (letter_changed, "not those")):
        with pytest.raises(Exception, match=why):
            dumps.restore(spark, damaged(change), schemas, roots)
        assert tables.versions(spark, roots["notes"]) == []
    assert not list((tmp_path / "notes").glob("*"))
    assert dumps.restore(spark, damaged(lines_turned), schemas, roots) == {"notes": 0}
    assert same(tables.read_snapshot(spark, roots["notes"], COLLECTION_SCHEMA)[1], notes)


def test_restore_of_an_empty_table(spark, notes, tmp_path):
    folder, root = str(tmp_path / "dump"), str(tmp_path / "notes")
    dumps.export_tables({"notes": notes.limit(0)}, folder)
    assert dumps.restore(spark, folder, {"notes": COLLECTION_SCHEMA}, {"notes": root}) == {"notes": 0}
    assert tables.read_snapshot(spark, root, COLLECTION_SCHEMA)[1].collect() == []
