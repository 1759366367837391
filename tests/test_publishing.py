"""Files that appear together, publishing by manifest, streams that resume, and upserts."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lawloom import publish
from lawloom.operators import changes
from lawloom.operators.documents import bill_documents, bill_records
from lawloom.operators.quality import below_gate, gate_measures
from lawloom.plans.bills_view import bills
from lawloom.schemas import BILL_RECORD
from lawloom.sources import readers, sinks, staging
from lawloom.streaming import landing
from lawloom.streaming.upsert import ROW, UpsertTable, upsert


@pytest.fixture(scope="module")
def records(spark, sf_dir, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("records") / "all")
    bill_records(bill_documents(bills(spark, sf_dir)), "https://x.org/").write.parquet(place)
    return spark.read.schema(BILL_RECORD).parquet(place)


def files_below(root: Path) -> list[str]:
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def bad_row(spark, name):
    return spark.createDataFrame([("a.txt", "one"), (name, "two")], "name string, content string")


def test_files_appear_together(spark, tmp_path):
    df = spark.range(50).select(F.concat(F.lit("d/"), F.col("id") % 5, F.lit("/"), "id").alias("name"), F.col("id").cast("string").alias("content")).repartition(3)
    assert sinks.write_files(df, f"file://{tmp_path}/x", F.col("name"), F.col("content")) == 50
    assert len(files_below(tmp_path / "x")) == 50 and (tmp_path / "x" / "d" / "2" / "7").read_text() == "7"
    assert sinks.write_files(df.limit(0), f"file://{tmp_path}/x", F.col("name"), F.col("content")) == 0
    fails = F.when(F.col("id") == 49, F.raise_error("broken")).otherwise("new")
    with pytest.raises(Exception, match="broken"):
        sinks.write_files(spark.range(50).repartition(3), f"file://{tmp_path}/x", F.concat(F.lit("d/0/"), F.col("id")), fails)
    assert len(files_below(tmp_path / "x")) == 50 and (tmp_path / "x" / "d" / "0" / "5").read_text() == "5"


@pytest.mark.parametrize("name", ["../out", "/etc/x", "a//b", "a/./b", "_staged/x", "a.txt"])
def test_names_stay_below_the_root(spark, tmp_path, name):
    with pytest.raises(Exception, match=r"not a name below|two files for one place"):
        sinks.write_files(bad_row(spark, name), f"file://{tmp_path}/x", F.col("name"), F.col("content"))
    assert not [f for f in files_below(tmp_path) if not f.startswith("x/_staged")]


RETRIED = """
import sys
sys.path.insert(0, {repo!r})
from pathlib import Path
from pyspark.sql import SparkSession, functions as F
from lawloom.sources import sinks
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {root!r} + "/wh").getOrCreate()

@F.udf("string")
def once(i):
    mark = Path({root!r}) / "failed"
    if i == 19 and not mark.exists():
        mark.write_text("x")
        raise RuntimeError("first attempt")
    return str(i)

df = spark.range(0, 20, 1, 2).select(F.concat(F.lit("f"), "id").alias("name"), once("id").alias("content"))
print("files", sinks.write_files(df, "file://" + {root!r} + "/out", F.col("name"), F.col("content")))
"""


def test_a_task_that_fails_once(tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", RETRIED.format(repo=repo, root=str(tmp_path))], capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": repo})
    assert "files" in done.stdout, done.stderr[-2000:]
    assert (tmp_path / "failed").exists()
    assert files_below(tmp_path / "out") == sorted(f"f{i}" for i in range(20))


def test_cut_off_commits_are_carried_on(tmp_path):
    root, job = str(tmp_path), staging.new_job()
    (tmp_path / "kept").write_text("old")
    (tmp_path / "gone").write_text("old")
    place = tmp_path / staging.STAGED / job
    place.mkdir(parents=True)
    for name in ("a", "b"):
        (place / name).write_text(name)
    moves = {"moves": [["a", "kept"], ["b", "sub/new"]], "drop": ["gone"]}
    (place / "moves.json.part").write_text(json.dumps(moves))
    assert staging.recover(root) == 0 and (tmp_path / "kept").read_text() == "old"  # the list isn't complete
    (place / "moves.json.part").rename(place / "moves.json")
    (place / "a").rename(tmp_path / "kept")  # one move had been made
    staging.abort(root, job)  # too late
    assert staging.recover(root) == 1
    assert files_below(tmp_path) == ["kept", "sub/new"] and (tmp_path / "kept").read_text() == "a"


def test_publishing(spark, records, tmp_path, monkeypatch):
    to = publish.FolderPublisher(tmp_path / "hub")
    one = records.where("session = 125")
    n = publish.publish_session(records, 125, to, tmp_path / "work")
    assert n == one.count() and to.messages == [f"Session 125: {n} records"]
    first = publish.manifest(to.root)
    assert [x["path"] for x in first["125"]] == ["data/125/train-00000-of-00001.parquet"] and first["125"][0]["rows"] == n
    publish.publish_session(records.repartition(3), 126, to, tmp_path / "work")
    assert publish.published(spark, to.root, 125).exceptAll(one).isEmpty()
    assert publish.published(spark, to.root).count() == records.where("session in (125, 126)").count()
    # three files become one: the others go with the commit
    assert len(publish.manifest(to.root)["126"]) == 3
    publish.publish_session(records.coalesce(1), 126, to, tmp_path / "work")
    assert [x.rpartition("/")[2] for x in files_below(tmp_path / "hub" / "data" / "126")] == ["train-00000-of-00001.parquet"]
    # a killed upload leaves what was there
    before, held = publish.manifest(to.root), files_below(tmp_path / "hub")

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(staging, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        publish.publish_session(records.limit(3), 125, to, tmp_path / "work")
    monkeypatch.undo()
    assert publish.manifest(to.root) == before
    assert [f for f in files_below(tmp_path / "hub") if not f.startswith(staging.STAGED)] == held
    monkeypatch.setattr(publish, "uploaded", killed)
    with pytest.raises(KeyboardInterrupt):
        publish.publish_session(records.limit(3), 125, to, tmp_path / "work")
    assert publish.manifest(to.root) == before


def test_counted_while_written(spark, records, tmp_path):
    """Rows and rates come from the writing job: the input is scanned once."""
    scanned = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            scanned.add(b.num_rows)
            yield b

    counted = records.coalesce(1).mapInArrow(seen, BILL_RECORD)
    done = sinks.write_session_files(counted, 125, str(tmp_path), measures=gate_measures())
    want = records.where("session = 125").agg(F.count("*"), *map(F.avg, gate_measures().values())).first()
    assert scanned.value == records.count()
    assert [done.counted[k] for k in ("rows", *gate_measures())] == list(want)
    assert below_gate({"sponsor_rate": 0.5, "session_rate": None}) == {"sponsor_rate": 0.5}


def test_sessions_from_one_scan(spark, records, tmp_path):
    scanned = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            scanned.add(b.num_rows)
            yield b

    (tmp_path / "125").mkdir()
    (tmp_path / "125" / "train-00007-of-00009.parquet").write_text("old")
    done = sinks.write_all_session_files(records.coalesce(1).mapInArrow(seen, BILL_RECORD), [125, 126, 999], str(tmp_path), measures=gate_measures())
    assert scanned.value == records.count()
    for s in (125, 126):
        own = records.where(F.col("session") == s)
        want = own.agg(F.count("*"), *map(F.avg, gate_measures().values())).first()
        assert [done[s].counted[k] for k in ("rows", *gate_measures())] == list(want)
        back = spark.read.schema(BILL_RECORD).parquet(str(tmp_path / str(s)))
        assert back.exceptAll(own).isEmpty() and back.count() == want[0]
        assert files_below(tmp_path / str(s)) == ["_SUCCESS", "train-00000-of-00001.parquet"] or files_below(tmp_path / str(s)) == ["train-00000-of-00001.parquet"]
    assert done[999].counted["rows"] == 0 and spark.read.parquet(str(tmp_path / "999")).columns == BILL_RECORD.fieldNames()


def test_a_stream_of_sessions_resumes(spark, records, tmp_path):
    for s in (124, 125, 126, 127):
        sinks.write_session_files(records, s, str(tmp_path / "data"))
    seen, mark = [], str(tmp_path / "mark")

    def half(batch, number):
        if number == 2:
            raise RuntimeError("stop")
        seen.extend(r[0] for r in batch.select("source_filename").collect())

    stream = lambda *only: readers.session_stream(spark, str(tmp_path / "data"), *only, files_per_trigger=1)
    with pytest.raises(Exception, match="stop"):
        readers.consume(stream(), mark, half)
    n = len(seen)
    readers.consume(stream(), mark, lambda b, k: seen.extend(r[0] for r in b.select("source_filename").collect()))
    want = sorted(r[0] for r in records.where("session between 124 and 127").select("source_filename").collect())
    assert 0 < n < len(want) and sorted(seen) == want
    only = []
    readers.consume(stream(125, 127), str(tmp_path / "mark2"), lambda b, k: only.extend(r[0] for r in b.select("session").distinct().collect()))
    assert sorted(only) == [125, 127]


def test_iteration_resumes(spark, records, tmp_path):
    for s in (125, 126):
        sinks.write_session_files(records.repartition(2), s, str(tmp_path / "data"))
    rows = list(readers.iterate(spark, str(tmp_path / "data")))
    assert len(rows) == records.where("session in (125, 126)").count() > 4
    assert rows[0][1].asDict().keys() == set(BILL_RECORD.fieldNames())
    k = len(rows) // 2
    rest = list(readers.iterate(spark, str(tmp_path / "data"), after=rows[k][0]))
    assert [p for p, _ in rest] == [p for p, _ in rows[k + 1 :]] and rest[0][1] == rows[k + 1][1]
    assert {r.session for _, r in readers.iterate(spark, str(tmp_path / "data"), 126)} == {126}


def test_upsert(spark, sf_dir, tmp_path):
    land, mark, table = str(tmp_path / "land"), str(tmp_path / "mark"), UpsertTable(spark, str(tmp_path / "table"))
    b = bills(spark, sf_dir).select("filename", "raw_text").where("filename rlike '^12[56]-LD'")
    n = b.count()
    go = lambda **k: upsert(landing(spark, land), "u/", table, mark, **k).awaitTermination()
    b.coalesce(1).write.parquet(land)
    go()
    assert table.current().count() == n and table.changes(0).where("action = 'insert'").count() == n
    # the same texts again, and one of them changed
    name = b.where("filename like '125%'").first()["filename"]
    b.coalesce(1).write.mode("append").parquet(land)
    go()
    assert table.current().count() == n and table.changes(1).isEmpty()
    changed = b.where(F.col("filename") == name).withColumn("raw_text", F.lit("125th MAINE LEGISLATURE\nAn Act Anew"))
    changed.coalesce(1).write.mode("append").parquet(land)
    go()
    r = table.current(125).where(F.col("source_filename") == name).collect()
    assert [x["title"] for x in r] == ["An Act Anew"] and table.current().count() == n
    assert [(x["source_filename"], x["action"]) for x in table.changes(2).collect()] == [(name, "change")]
    # a batch that runs again, after its commit and before it
    state = table.state()
    again = spark.createDataFrame(table.current(125).collect(), ROW)
    assert table.apply(again, 2, [125]) is False and table.state() == state
    (tmp_path / "table" / "state.json").write_text(json.dumps({"batch": 1, "sessions": {s: f"data/batch=1/part={s}" for s in ("125", "126")}}))
    assert table.apply(again, 2, [125]) and table.current().count() == n
    # a complete scrape: what it lacks vanishes, other sessions stay
    assert table.apply(again.where(F.col("source_filename") == name), 3, [125], complete=True)
    assert [x["source_filename"] for x in table.current(125).collect()] == [name]
    assert table.changes(3).where("action = 'vanish'").count() == again.count() - 1
    assert table.current(126).count() == b.where("filename like '126%'").count()


def test_changes_of_odd_rows(spark):
    schema = "k string, v string, digest string"
    old = spark.createDataFrame([("a", "1", "x"), ("b", "1", "x"), ("c", "1", None)], schema)
    new = spark.createDataFrame([("a", "2", "x"), ("b", "2", "y"), ("c", "2", None), ("d", "2", "z")], schema)
    rows = {r["k"]: (r["v"], r["action"]) for r in changes.merged(old, new, "k").collect()}
    assert rows == {"a": ("1", "same"), "b": ("2", "change"), "c": ("1", "same"), "d": ("2", "insert")}
    assert {r["action"] for r in changes.merged(old, new.limit(0), "k").collect()} == {"same"}
    assert {r["action"] for r in changes.merged(old, new.limit(0), "k", complete=F.col("k") == "a").collect()} == {"same", "vanish"}
    twice = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", None, "r")], "k string, t int, digest string")
    assert [tuple(r) for r in changes.latest(twice, "k", "t", "digest").collect()] == [("a", 2, "q")]
    d = spark.createDataFrame([(None, "x"), ("", "x"), ("null", "x")], "a string, b string").select(changes.digest("a", "b").alias("d"))
    assert d.distinct().count() == 3
