"""Releases that arrive over several runs."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gates as G
from tallyloom.operators.ledger import Ledger
from tallyloom.streaming.pieces import file_stream, ingest_pieces, waiting_releases

SCHEMA = "id int, v double"
MEMBERS = ["families", "persons", "weights"]


@pytest.fixture()
def place(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    ledger = Ledger(spark, str(tmp_path / "lake"))

    def put(survey, year, member, values, name=None):
        lines = "".join(f"{i},{v}\n" for i, v in enumerate(values))
        (incoming / (name or f"{survey}_{year}_{member}.csv")).write_text(lines)

    def run():
        part = lambda k: F.regexp_extract("path", r"/([a-z ]+)_(\d+)_([a-z]+)[^/]*\.csv$", k)
        files = file_stream(spark, str(incoming), part(1), part(2), part(3))
        read = lambda s, paths: s.read.schema(SCHEMA).csv(paths)
        ingest_pieces(files, ledger, [G.row_minimum(3)], str(tmp_path / "cp"), MEMBERS, read).awaitTermination()

    return put, run, ledger, str(tmp_path / "cp")


def test_a_release_over_three_runs(spark, place):
    put, run, ledger, checkpoint = place
    put("cps", 2023, "families", [1.0, 2.0])
    put("ahs", 2023, "families", [5.0])
    put("note", 2023, "readme", [0.0])
    run()
    assert ledger.releases().count() == 0
    held = {r["survey"]: (r["present"], r["missing"]) for r in waiting_releases(spark, checkpoint, MEMBERS).collect()}
    assert held["cps"] == (["families"], ["persons", "weights"])
    put("cps", 2023, "persons", [3.0, 4.0, 5.0])
    run()
    assert ledger.releases().count() == 0
    put("cps", 2023, "weights", [6.0])
    run()
    row = ledger.releases().first()
    assert (row["survey"], row["year"], row["status"], row["n_rows"]) == ("cps", 2023, "promoted", 6)
    assert sorted(r["v"] for r in ledger.read("cps").collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    # Nothing new: nothing changes. The other survey stays invisible.
    run()
    assert ledger.releases().count() == 1
    assert [r["survey"] for r in waiting_releases(spark, checkpoint, MEMBERS).collect() if r["survey"] != "note"] == ["ahs"]


def test_a_late_file_revises_its_member(place):
    put, run, ledger, _ = place
    for member, values in (("families", [1.0]), ("persons", [2.0]), ("weights", [3.0])):
        put("my survey", 2024, member, values)
    run()
    put("my survey", 2024, "weights", [4.0, 5.0], name="my survey_2024_weights_v2.csv")
    run()
    assert [(r["change"], r["n_rows"]) for r in ledger.releases().orderBy("seq").collect()] == [("new", 3), ("changed", 4)]
    assert sorted(r["v"] for r in ledger.read("my survey").collect()) == [1.0, 2.0, 4.0, 5.0]


def test_a_lost_run_is_repeated(spark, place, monkeypatch):
    """The first try of a run fails after the data were written; the second gives one release."""
    put, run, ledger, _ = place
    for member in MEMBERS:
        put("cps", 2020, member, [1.0, 2.0])
    real = Ledger.promote

    def broken(self, *args, **kwargs):
        real(self, *args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(Ledger, "promote", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(Ledger, "promote", real)
    run()
    assert ledger.releases().count() == 1 and ledger.read("cps").count() == 6
