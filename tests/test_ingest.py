"""Ingest job and ledger (S1–S12): typed rows, dense ids, idempotent re-runs."""

from __future__ import annotations

import csv
import glob
import gzip
import hashlib
import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shared import SF_SMALL
from postline.plans import ingest
from postline.plans.ingest import Paths, committed_landing, ingest_files, read_entries, read_ledger
from postline.schemas import SOURCE_COLUMNS
from postline.sources import files, ledger
from postline.sources.driver_tables import postings_source


def _write_csv_files(spark, n_files=2):
    """CSV files of posting cells derived from the driver tables (quoted, header)."""
    root = tempfile.mkdtemp(prefix="postline-test-csv-")
    src = postings_source(spark, SF_SMALL).orderBy("source_row")
    for i in range(n_files):
        part = src.where(F.col("batch") == i).drop("batch").orderBy("source_row")
        out = f"{root}/tmp{i}"
        (part.coalesce(1).write.option("header", "true").option("quoteAll", "true").option("escape", '"')
         .csv(out))
    return root, [glob.glob(f"{root}/tmp{i}/*.csv")[0] for i in range(n_files)]


def test_fingerprint_equals_python_md5(spark):
    root, paths = _write_csv_files(spark, 1)
    got = files.fingerprint_files(spark, paths).collect()[0]
    with open(paths[0], "rb") as fh:
        assert got.file_md5 == hashlib.md5(fh.read()).hexdigest()


def test_ingest_then_skip(spark):
    root, paths = _write_csv_files(spark, 2)
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    t0 = datetime(2024, 5, 1, 12, 0, 0)
    stats = ingest_files(spark, paths, store, source_name="test", now=t0).collect()
    assert len(stats) == 2 and not any(s.skipped for s in stats)
    landed = committed_landing(spark, store)
    n = landed.count()
    assert n == sum(s.total_rows for s in stats) > 0
    ids = sorted(r.id for r in landed.select("id").collect())
    assert ids == list(range(1, n + 1))                        # dense, from 1
    # file order is kept: within a file ids follow the source rows
    for fpath in paths:
        md5 = hashlib.md5(open(fpath, "rb").read()).hexdigest()
        part = landed.where(F.col("file_md5") == md5).orderBy("id").select("job_title").collect()
        src_rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"') \
            .csv(fpath).select("job_title").collect()
        assert len(part) == len(src_rows)
    ledger_rows = read_ledger(spark, store).collect()
    assert {r.status for r in ledger_rows} == {"completed"}
    assert ledger.invalid_status(read_ledger(spark, store)).count() == 0

    # second run: everything is completed, nothing is read or written
    before = sorted(tuple(r) for r in read_ledger(spark, store).collect())    # skips change no ledger row
    again = ingest_files(spark, paths, store, source_name="test", now=datetime(2024, 6, 1)).collect()
    assert len(again) == 2 and all(r.skipped and r.total_rows == 0 and r.inserted_rows == 0 for r in again)
    assert sorted(tuple(r) for r in read_ledger(spark, store).collect()) == before
    assert committed_landing(spark, store).count() == n


def _run(spark, paths, store, **options):
    """Entries by file name; asserts one for each."""
    rows = ingest_files(spark, paths, store, **options).collect()
    by_name = {r.file_path.rsplit("/", 1)[-1]: r for r in rows}
    assert len(by_name) == len(rows)
    return by_name


def _csv(path, rows, header="job_title,company_name"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = "\n".join([header, *rows]) + "\n"
    with (gzip.open(path, "wt") if path.endswith(".gz") else open(path, "w")) as fh:
        fh.write(data)
    return path


def test_no_file_and_no_row_is_lost(spark):
    """Odd paths, packed files, equal copies, files without rows: one entry each, all rows landed."""
    root = tempfile.mkdtemp(prefix="postline-test-odd-")
    paths = [
        _csv(f"{root}/in dir/my file.csv", ["a,A", "b,B"]),
        _csv(f"{root}/100%/x%20y+z.csv", ["c,C"]),
        _csv(f"{root}/zip/packed.csv.gz", ["d,D", "e,E", '"f\ng",F']),
        _csv(f"{root}/copy one.csv", ["h,H"]),
        _csv(f"{root}/copy two.csv", ["h,H"]),
        _csv(f"{root}/empty.csv", []),
        _csv(f"{root}/other.csv", ["1,2"], header="x,y"),
        _csv(f"{root}/ümläut.csv", ["i,I"]),
    ]
    open(f"{root}/zero.csv", "w").close()
    paths.append(f"{root}/zero.csv")
    with open(f"{root}/broken.csv.gz", "wb") as fh:
        fh.write(b"\x1f\x8bnot gzip at all")
    paths.append(f"{root}/broken.csv.gz")
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    got = _run(spark, paths, store)
    assert set(got) == {p.rsplit("/", 1)[-1] for p in paths}
    assert {n: (r.status, r.inserted_rows) for n, r in got.items()} == {
        "my file.csv": ("completed", 2), "x%20y+z.csv": ("completed", 1), "packed.csv.gz": ("completed", 3),
        "copy one.csv": ("completed", 1), "copy two.csv": ("skipped", 0), "empty.csv": ("completed", 0),
        "other.csv": ("failed", 0), "ümläut.csv": ("completed", 1), "zero.csv": ("failed", 0),
        "broken.csv.gz": ("failed", 0)}
    assert read_entries(spark, store).count() == len(paths)
    landed = committed_landing(spark, store).select("id", "job_title", "company_name").collect()
    assert sorted(r.company_name for r in landed) == list("ABCDEFHI")
    assert sorted(r.id for r in landed) == list(range(1, 9))
    assert next(r.job_title for r in landed if r.company_name == "F") == "f\ng"
    again = _run(spark, paths, store)
    assert {r.status for n, r in again.items() if got[n].status != "failed"} == {"skipped"}
    assert committed_landing(spark, store).count() == 8


def test_fingerprint_reads_in_blocks(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="postline-test-blocks-")
    path = _csv(f"{root}/f.csv", [f'"t{i} ""q""",c{i}' for i in range(500)])
    with open(path, "rb") as fh:
        data = fh.read()
    for size in (7, 64, 1 << 20):
        monkeypatch.setattr(files, "BLOCK_BYTES", size)
        assert files.scan_file(path) == (hashlib.md5(data).hexdigest(), len(data), ["job_title", "company_name"], False, None)
    quoted = _csv(f"{root}/q.csv", ["a,b", '"x\ny",z'], header='"job_title","company\nname"')
    monkeypatch.setattr(files, "BLOCK_BYTES", 5)
    assert files.scan_file(quoted)[2:] == (["job_title", "company\nname"], True, None)


def test_a_run_that_ends_before_its_commit_leaves_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="postline-test-crash-")
    path = _csv(f"{root}/f.csv", ["a,A", "b,B"])
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_files(spark, path, store)
    assert committed_landing(spark, store).count() == 0 and read_ledger(spark, store).count() == 0
    assert _run(spark, path, store)["f.csv"].status == "completed"
    assert sorted(r.id for r in committed_landing(spark, store).collect()) == [1, 2]


def test_interleaved_runs_have_unique_ids(spark, monkeypatch):
    """A second run lands and commits between the landing and the commit of the first."""
    root = tempfile.mkdtemp(prefix="postline-test-two-")
    one, two = _csv(f"{root}/one.csv", ["a,A", "b,B"]), _csv(f"{root}/two.csv", ["c,C", "d,D", "e,E"])
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    commit, ran = ingest._commit, []

    def late(*args):
        if not ran:
            ran.append(1)
            ingest_files(spark, [two, one], store)
        commit(*args)

    monkeypatch.setattr(ingest, "_commit", late)
    ingest_files(spark, one, store)
    landed = committed_landing(spark, store).select("id", "company_name").collect()
    assert sorted(r.company_name for r in landed) == list("ABCDE")        # the file both loaded counts once
    assert len({r.id for r in landed}) == 5
    assert read_ledger(spark, store).count() == 2 and read_entries(spark, store).count() == 3


def test_columns_matched_by_name(spark):
    root = tempfile.mkdtemp(prefix="postline-test-byname-")
    path = os.path.join(root, "f.csv")
    with open(path, "w") as fh:
        fh.write('company_name,extra,job_title\n"Acme","x","  Data Engineer "\n')
    df = files.read_postings_csv(spark, [path])
    row = df.collect()[0]
    assert row.company_name == "Acme" and row.job_title == "  Data Engineer " and row.job_via is None
    assert [c for c in df.columns if not c.startswith("_")] == SOURCE_COLUMNS


def test_ledger_upsert_keeps_origin_fields(spark):
    old = ledger.run_entries(spark.createDataFrame(
        [("m1", "p/old", "s1", 5, 5, 0, 0, 0, 0, 0)],
        "file_md5 string, file_path string, source_name string, total_rows long, inserted_rows long, "
        "parse_warnings long, job_skills_missing long, job_skills_invalid long, job_type_skills_missing long, "
        "job_type_skills_invalid long"), datetime(2024, 1, 1), None, status="failed")
    new = ledger.run_entries(spark.createDataFrame(
        [("m1", "p/new", "s2", 7, 7, 1, 0, 1, 0, 0), ("m2", "p/two", "s2", 3, 3, 0, 0, 0, 0, 0)],
        old.select("file_md5", "file_path", "source_name", *ledger.COUNTERS).schema),
        datetime(2024, 2, 1), datetime(2024, 2, 2))
    merged = {r.file_md5: r for r in ledger.upsert_ledger(old, new).collect()}
    m1 = merged["m1"]
    assert (m1.file_path, m1.source_name, m1.started_at) == ("p/old", "s1", datetime(2024, 1, 1))
    assert (m1.status, m1.total_rows, m1.finished_at) == ("completed", 7, datetime(2024, 2, 2))
    assert merged["m2"].file_path == "p/two"
    latest = ledger.latest_runs(ledger.upsert_ledger(old, new), 1).collect()
    assert latest[0].file_md5 == "m1"          # ties on finish time → by fingerprint


def test_stream_ingest_is_idempotent(spark):
    from postline.streaming.file_ingest import start_file_ingest
    root, paths = _write_csv_files(spark, 2)
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    q = start_file_ingest(spark, root, store, checkpoint=f"{root}/_stream_ckpt", available_now=True)
    q.awaitTermination(300)
    n = committed_landing(spark, store).count()
    assert n > 0 and read_ledger(spark, store).count() == 2
    # a fresh stream over the same files (new checkpoint) loads nothing twice
    q2 = start_file_ingest(spark, root, store, checkpoint=f"{root}/_stream_ckpt2", available_now=True)
    q2.awaitTermination(300)
    assert committed_landing(spark, store).count() == n


def test_file_positions_across_split_partitions(spark):
    """A file read in several splits still gets dense positions in file order."""
    root = tempfile.mkdtemp(prefix="postline-test-split-")
    path = os.path.join(root, "big.csv")
    n = 20000
    with open(path, "w") as fh:
        fh.write("job_title,company_name\n")
        for i in range(n):
            fh.write(f"title {i:06d},co{i % 97}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = files.read_postings_csv(spark, [path])
        assert df.rdd.getNumPartitions() > 3
        rows = files.with_file_positions(df).select("_pos", "job_title").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r._pos, r.job_title) for r in rows)
    assert got == [(i, f"title {i:06d}") for i in range(n)]


def test_file_with_extra_fields_fails_alone(spark):
    root = tempfile.mkdtemp(prefix="postline-test-bad-")
    good, bad = os.path.join(root, "good.csv"), os.path.join(root, "bad.csv")
    with open(good, "w") as fh:
        fh.write('job_title,company_name\n"Analyst","Acme"\n"Engineer",""\n')
    with open(bad, "w") as fh:
        fh.write('company_name,job_title\n"Beta","Dev"\n"Gamma","Ops","surplus"\n')
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    stats = {r.file_path.rsplit("/", 1)[-1]: r for r in ingest_files(spark, [good, bad], store).collect()}
    assert stats["good.csv"].status == "completed" and stats["good.csv"].inserted_rows == 2
    assert stats["bad.csv"].status == "failed" and stats["bad.csv"].inserted_rows == 0
    landed = committed_landing(spark, store).select("id", "company_name", "job_title").orderBy("id").collect()
    assert [(r.id, r.company_name, r.job_title) for r in landed] == [(1, "Acme", "Analyst"), (2, None, "Engineer")]  # cells are cleaned
    statuses = {r.file_path.rsplit("/", 1)[-1]: r.status for r in read_ledger(spark, store).collect()}
    assert statuses == {"good.csv": "completed", "bad.csv": "failed"}
    # a failed file is pending again on the next run
    again = {r.file_path.rsplit("/", 1)[-1]: r.status for r in ingest_files(spark, [good, bad], store).collect()}
    assert again == {"good.csv": "skipped", "bad.csv": "failed"}


def test_run_build_chains_the_three_steps(spark):
    from postline.plans.build import run_build
    root, paths = _write_csv_files(spark, 2)
    store = Paths(landing=f"{root}/landing", ledger=f"{root}/ledger")
    stats, tables, results = run_build(spark, paths, store, f"{root}/warehouse", fail_fast=False)
    assert len(stats) == 2 and tables["job_posting"].count() > 0
    assert len(results) == 59
    failing = {name for name, n in results if n}
    assert failing <= {"unique(stg_job_skills_exploded.skill_assignment_id)"}


@pytest.mark.parametrize("range_orders", [7, 250_000])
def test_posting_files_are_joined_from_sorted_ranges(spark, monkeypatch, range_orders):
    """One file per batch, its rows in source order, however many ranges are sorted on their own."""
    from postline.plans import csv_loads
    joined = {}
    join = files.join_files
    monkeypatch.setattr(csv_loads, "RANGE_ORDERS", range_orders)
    monkeypatch.setattr(csv_loads.files, "join_files", lambda s, parts, *rest: (joined.update(parts), join(s, parts, *rest)))
    folder = csv_loads.write_posting_files(spark, SF_SMALL, tempfile.mkdtemp(prefix="postline-test-csv-") + "/csv")
    assert not os.path.exists(f"{folder}-ranges")
    assert all(len(parts) > 4 if range_orders == 7 else len(parts) == 1 for parts in joined.values())
    source = postings_source(spark, SF_SMALL).orderBy("batch", "source_row").collect()
    for batch in sorted({r.batch for r in source}):
        (path,) = glob.glob(f"{folder}/batch={batch}/*")
        with open(path, newline="") as fh:
            lines = list(csv.reader(fh))
        assert lines[0] == SOURCE_COLUMNS
        # the CSV writer drops blanks around a cell
        assert lines[1:] == [[(r[c] or "").strip(" ") for c in SOURCE_COLUMNS] for r in source if r.batch == batch]
