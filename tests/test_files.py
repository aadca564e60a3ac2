"""CSV by header names, staged publishing of a model, export by month."""

from __future__ import annotations

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions.numeric import sum_of_keys
from tallywright.model import TABLES
from tallywright.plans.catalog import RESULTS
from tallywright.plans.reports import validate_and_clean
from tallywright.sources import csv_files, files
from tallywright.sources.binding import BoundModel
from tallywright.sources.csv_files import csv_groups
from tests.test_batch import RAW



def small_schema():
    return T.StructType([
        T.StructField("id", T.StringType()), T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("day", T.DateType()), T.StructField("note", T.StringType()),
    ])


def rows(df):
    return {r.id: (None if r.amount is None else float(r.amount), r.day, r.note) for r in df.collect()}


@pytest.mark.parametrize("scan", [files.scan_csv, files.scan_raw_csv])
def test_columns_are_found_by_name(spark, tmp_path, scan):
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "a.csv").write_text("id,amount,day,note\na1,1.50,2026-01-02,plain\n")
    (folder / "b.csv").write_text("﻿note, day ,extra,id,amount\nlast,2026-01-03,x,b1,2\n,,,b2,\n")
    (folder / "c.csv").write_text('amount,id\n3,"c,1"\n')
    (folder / "d.csv").write_text("")
    (folder / "_SUCCESS").write_text("")
    with gzip.open(folder / "e.csv.gz", "wt") as packed:
        packed.write('note,id\n"a ""word""",e1\n')
    got = rows(scan(spark, str(folder), small_schema()))
    assert got == {
        "a1": (1.5, dt.date(2026, 1, 2), "plain"), "b1": (2.0, dt.date(2026, 1, 3), "last"),
        "b2": (None, None, None), "c,1": (3.0, None, None), "e1": (None, None, 'a "word"'),
    }


@pytest.mark.parametrize("scan", [files.scan_csv, files.scan_raw_csv])
def test_quoted_line_breaks_stay_in_their_record(spark, tmp_path, scan):
    (tmp_path / "a.csv").write_bytes(
        b'note,id,amount,day\r\n"first\nsecond, ""third""\r\n\nlast",a1,1,2026-01-02\r\nplain,a2,2,2026-01-03\r\n'
    )
    (tmp_path / "b.csv").write_text("id,amount,day,note\nb1,3,2026-01-04,one line\n")
    got = scan(spark, str(tmp_path), small_schema())
    assert rows(got) == {
        "a1": (1.0, dt.date(2026, 1, 2), 'first\nsecond, "third"\n\nlast'),
        "a2": (2.0, dt.date(2026, 1, 3), "plain"), "b1": (3.0, dt.date(2026, 1, 4), "one line"),
    }
    marks = {g.files[0][-5:]: g.multi_line for g in csv_groups(spark, str(tmp_path))}
    assert marks == {"a.csv": True, "b.csv": False}  # only the file that needs it loses its splits
    if scan is files.scan_csv:
        assert {r._corrupt_record for r in got.collect()} == {None}


def test_a_header_over_two_lines_and_repeated_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"no\nte",id,id,amount\nx,a1,other,7\n')
    [group] = csv_groups(spark, str(tmp_path))
    assert group.columns == ("no\nte", "id", "id", "amount") and group.multi_line
    assert rows(files.scan_raw_csv(spark, str(tmp_path), small_schema())) == {"a1": (7.0, None, None)}


def test_nothing_to_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    for scan in (files.scan_csv, files.scan_raw_csv):
        got = scan(spark, str(tmp_path), small_schema())
        assert got.columns[:4] == ["id", "amount", "day", "note"] and got.count() == 0
    with pytest.raises(Exception, match="no such path"):
        files.scan_csv(spark, str(tmp_path / "absent"), small_schema())


def shuffled(text, drop=None, add=None):
    """The columns of a small extract the other way round."""
    lines = [line.split(",") for line in text.splitlines()]
    at = [n for n in reversed(range(len(lines[0]))) if lines[0][n] != drop]
    out = [[line[n] for n in at] for line in lines]
    if add:
        out = [[*line, add if n == 0 else "x"] for n, line in enumerate(out)]
    return "\n".join(map(",".join, out)) + "\n"


def test_a_shuffled_extract_reads_like_the_declared_one(spark, tmp_path):
    for name, text in RAW.items():
        (tmp_path / f"{name}.csv").write_text(text)
        (tmp_path / f"shuffled-{name}.csv").write_text(shuffled(text))
    for name, spec in TABLES.items():
        one, two = (
            files.scan_raw_csv(spark, str(tmp_path / f"{part}{name}.csv"), spec.schema).drop("_source_order")
            for part in ("", "shuffled-")
        )
        assert one.columns == two.columns
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_missing_and_extra_columns_are_findings(spark, tmp_path):
    for name, text in RAW.items():
        text = shuffled(text, drop="city" if name == "merchants" else None, add="mood" if name == "disputes" else None)
        (tmp_path / f"{name}.csv").write_text(text)
    tables = files.read_raw_tables(spark, str(tmp_path))
    out = str(tmp_path / "out")
    validate_and_clean(tables, out)
    found = {
        (r.table_name, r.check_name, r.column_name): r.violations
        for r in spark.read.parquet(f"{out}/quality_findings").where("check_name LIKE '%column'").collect()
    }
    assert found == {("merchants", "missing_column", "city"): 1, ("disputes", "extra_column", "mood"): 1}
    assert tables["merchants"].where("city IS NULL AND state IS NOT NULL").count() == 2


# publishing


def model(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in RAW.items():
        (folder / f"{name}.csv").write_text(text)
    from tallywright.operators.cleaning import clean_all

    return clean_all(files.read_raw_tables(spark, str(folder)))


def test_a_failing_load_leaves_the_model_as_it_was(spark, tmp_path):
    tables, folder = model(spark, tmp_path), str(tmp_path / "model")
    files.load_model(tables, folder)
    first = files.published_version(spark, folder)
    held = files.read_model(spark, folder)["payments"]
    broken = {**tables, "payments": tables["payments"].withColumn("merchant_id", F.lit("nobody"))}
    with pytest.raises(ValueError, match="constraints violated"):
        files.load_model(broken, folder)
    assert files.published_version(spark, folder) == first
    assert {r.merchant_id for r in files.read_model(spark, folder)["payments"].collect()} == {"m1"}
    unwritable = {**tables, "disputes": tables["disputes"].withColumn("dispute_id", F.raise_error(F.lit("lost")))}
    with pytest.raises(Exception, match="lost"):
        files.load_model(unwritable, folder)
    assert files.published_version(spark, folder) == first and held.count() == 1
    assert [p.name for p in (tmp_path / "model" / "versions").iterdir()] == [first]


def test_versions_follow_one_another(spark, tmp_path):
    tables, folder = model(spark, tmp_path), str(tmp_path / "model")
    seen = []
    for amount in (10, 20, 30):
        changed = {**tables, "payments": tables["payments"].withColumn("payment_amount", F.lit(amount))}
        files.load_model(changed, folder)
        seen.append(files.published_version(spark, folder))
        assert [float(r.payment_amount) for r in files.read_model(spark, folder)["payments"].collect()] == [amount]
        held = files.read_model(spark, folder)["payments"] if amount == 20 else None if amount == 10 else held
    assert [float(r.payment_amount) for r in held.collect()] == [20]  # a reader of the version before
    assert {p.name for p in (tmp_path / "model" / "versions").iterdir()} == set(seen[1:])
    assert len({*seen}) == 3


# export by month


def stored(spark, path):
    return sorted((str(r.year_month), r.invoice_id, float(r.total_invoice_amount)) for r in spark.read.parquet(path).collect())


def test_only_the_months_asked_for_are_replaced(spark, tmp_path):
    def facts(*rows):
        data = [(i, dt.date.fromisoformat(day), float(amount)) for i, day, amount in rows]
        return {"fact_invoices": spark.createDataFrame(data, "invoice_id string, invoice_date date, total_invoice_amount double")}

    folder = str(tmp_path / "star")
    path = f"{folder}/fact_invoices"
    files.export_star(facts(("a", "2026-01-05", 1), ("b", "2026-02-05", 2), ("c", "2026-03-05", 3)), folder)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "star").rglob("year_month=2026-01/*.parquet")}
    later = facts(("a", "2026-01-05", 100), ("b", "2026-02-05", 200), ("d", "2026-02-09", 4))
    for _ in range(2):  # a second run changes nothing
        files.export_star(later, folder, months=["2026-02", "2026-03"])
        assert stored(spark, path) == [("2026-01", "a", 1.0), ("2026-02", "b", 200.0), ("2026-02", "d", 4.0)]
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "star").rglob("year_month=2026-01/*.parquet")}
    files.export_star(later, folder)
    assert stored(spark, path) == [("2026-01", "a", 100.0), ("2026-02", "b", 200.0), ("2026-02", "d", 4.0)]


def test_key_totals_beyond_bigint_wrap(spark):
    def total(keys):
        return spark.createDataFrame([(k,) for k in keys], "k bigint").agg(sum_of_keys(F.col("k"))).first()[0]

    assert total([3, None, -10]) == -7
    assert total([None]) is None
    for keys in ([2**63 - 1] * 3, [-(2**63)] * 2, [2**62] * 2):
        assert total(keys) == (sum(keys) + 2**63) % 2**64 - 2**63


def test_months_are_replaced_without_a_second_run(spark, tmp_path, monkeypatch):
    rows = [(dt.date(2026, m, 1),) for m in (1, 2)]
    facts = {"fact_invoices": spark.createDataFrame(rows, "invoice_date date")}
    files.export_star(facts, str(tmp_path))

    def again(frame):
        raise AssertionError("the fact was computed once more for its months")

    monkeypatch.setattr(type(facts["fact_invoices"]), "collect", again)
    later = {"fact_invoices": facts["fact_invoices"].where("month(invoice_date) = 1")}
    files.export_star(later, str(tmp_path), months=("2026-01", "2026-02"))
    monkeypatch.undo()
    left = [r.year_month for r in spark.read.parquet(f"{tmp_path}/fact_invoices").collect()]
    assert [str(month) for month in left] == ["2026-01"]


def test_written_csv_is_not_searched_for_line_breaks(spark, monkeypatch):
    def search(*args):
        raise AssertionError("numbers and labels hold no line breaks")

    monkeypatch.setattr(csv_files, "_with_quoted_breaks", search)
    model = BoundModel(spark, "/root/testdata/sf0.001", "no-breaks")
    assert RESULTS["write_csv"](model).count() == model["invoices"].count()
