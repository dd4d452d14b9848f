"""Arriving files: own headers, any width, bad files, and runs that take only new files."""

from urllib.parse import unquote_plus

from compare import rows

from churnlake.streaming import arrivals

GOOD = "customerID,Contract,MonthlyCharges,Churn\nAUTO001,Month-to-month,89.50,1\nAUTO002,One year,65.00,0\nAUTO003,Month-to-month,99.00,1\nAUTO004,Two year,45.00,0\nAUTO005,Month-to-month,75.00,0\n"
TURNED = "Churn,Extra,customerID,MonthlyCharges,Contract\nTrue,x,A1,10,One year\n0,x,,10,One year\nYes,x,A3,,One year\n"
BROKEN = "some,other,file\n1,2,3\n"
WIDE = ",".join(["customerID", *[f"x{i}" for i in range(34)], "Churn", "MonthlyCharges", "Contract"])
WIDE += "\n" + "\n".join(",".join([f"w{k}", *["v"] * 34, "1", "5.5", "One year"]) for k in range(3)) + "\n"
ODD = 'customerID,MonthlyCharges,Churn,note\nk1,1,0,"two\nlines, quoted"\nk2,9.5,1,customerID\ncustomerID,2,0,"say ""hi"""\n'


def _run(spark, root):
    query = arrivals.stream_incoming_files(
        spark, f"{root}/incoming", f"{root}/processed", f"{root}/results", f"{root}/check", "now"
    )
    query.awaitTermination()


def _results(spark, root):
    out = arrivals.read_results(spark, f"{root}/results")
    return {
        r["source_file"].split("/incoming/")[1]: (
            r["total_records"], r["valid"], r["invalid"], r["churned"], r["churn_rate_pct"], r["status"]
        )
        for r in out.collect()
    }


def test_files_are_processed_once_and_fail_alone(spark, tmp_path):
    incoming = tmp_path / "incoming"
    (incoming / "a").mkdir(parents=True)
    (incoming / "b").mkdir()
    (incoming / "a" / "x.csv").write_text(GOOD)
    (incoming / "b" / "x.csv").write_text(WIDE)
    (incoming / "broken.csv").write_text(BROKEN)
    (incoming / "headed.csv").write_text("customerID,MonthlyCharges\n")
    (incoming / "note.txt").write_text("not a file for us")
    _run(spark, tmp_path)
    assert _results(spark, tmp_path) == {
        "a/x.csv": (5, 5, 0, 2, 40.0, "SUCCESS"),
        "b/x.csv": (3, 3, 0, 3, 100.0, "SUCCESS"),
        "broken.csv": (2, 0, 2, 0, 0.0, "FAILED"),
        "headed.csv": (0, 0, 0, 0, 0.0, "SUCCESS"),
    }
    (incoming / "turned.csv").write_text(TURNED)
    (incoming / "odd.csv").write_text(ODD)
    _run(spark, tmp_path)
    got = _results(spark, tmp_path)
    assert got["turned.csv"] == (3, 1, 2, 2, 66.7, "SUCCESS") and len(got) == 6
    assert got["odd.csv"] == (3, 3, 0, 1, 33.3, "SUCCESS")
    stored = arrivals.read_processed(spark, f"{tmp_path}/processed")
    assert stored.count() == 5 + 3 + 3 + 3
    assert {f"x{i}" for i in range(34)} | {"Extra", "note"} <= set(stored.columns)
    assert stored.filter("x33 = 'v'").count() == 3 and stored.filter("Extra = 'x'").count() == 3
    assert rows(stored.filter("note is not null"), "customerID", "note") == [
        ("customerID", 'say "hi"'), ("k1", "two\nlines, quoted"), ("k2", "customerID"),
    ]
    sources = {unquote_plus(r["source"]).split("/incoming/")[1] for r in stored.select("source").distinct().collect()}
    assert sources == {"a/x.csv", "b/x.csv", "turned.csv", "odd.csv"}
    places = {r["output_file"] for r in arrivals.read_results(spark, f"{tmp_path}/results").collect() if r["status"] == "SUCCESS"}
    assert len(places) == 5


def test_scan_of_one_file(spark, tmp_path):
    (tmp_path / "good.csv").write_text(GOOD)
    (tmp_path / "other.csv").write_text(TURNED)
    assert arrivals.on_demand_file_scan(spark, str(tmp_path / "good.csv")).count() == 5
    both = arrivals.on_demand_file_scan(spark, str(tmp_path))
    assert both.count() == 8 and "Extra" in both.columns


def test_headers_keep_every_column():
    assert arrivals.header_names("\ufeffa, b ,A,,a,\"c,d\"") == ["a", "b", "A_2", "_c3", "a_4", "c,d"]


def test_own_columns_of_any_name_and_files_of_any_state(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (incoming / "a b+%20%.csv").write_text(GOOD)
    (incoming / "own.csv").write_text("customerID,Source,source_file,auto_processed_at,batch,a`b,c.d,MonthlyCharges\nk1,s,f,t,b,x,y,5\n")
    (incoming / "empty.csv").write_text("")
    (incoming / "latin.csv").write_bytes("customerID,MonthlyCharges\nJos\xe9,5\n".encode("latin-1"))
    (incoming / "good.csv").write_text(GOOD)
    _run(spark, tmp_path)
    got = _results(spark, tmp_path)
    assert got == {
        "own.csv": (1, 1, 0, 0, 0.0, "SUCCESS"),
        "latin.csv": (0, 0, 0, 0, 0.0, "FAILED"),
        "good.csv": (5, 5, 0, 2, 40.0, "SUCCESS"),
        "a%20b+%2520%25.csv": (5, 5, 0, 2, 40.0, "SUCCESS"),
    }
    # The stream does not see a file of no bytes; asked for by path, it is processed with zeros.
    paths = [f"file://{incoming}/{n}.csv" for n in ("empty", "good")]
    told = arrivals.file_results(*arrivals.read_files(spark, paths), "now").collect()
    assert {(r["source_file"].rsplit("/", 1)[1], r["total_records"], r["status"]) for r in told} == {("empty.csv", 0, "SUCCESS"), ("good.csv", 5, "SUCCESS")}
    stored = arrivals.read_processed(spark, f"{tmp_path}/processed").filter("customerID = 'k1'").first().asDict()
    assert unquote_plus(stored["source"]).endswith("/incoming/own.csv") and stored["auto_processed_at"] == "now"
    assert (stored["Source_1"], stored["source_file_2"], stored["auto_processed_at_3"], stored["batch_4"]) == ("s", "f", "t", "b")
    assert (stored["a`b"], stored["c.d"]) == ("x", "y")
    assert arrivals.on_demand_file_scan(spark, str(incoming / "own.csv")).first()["Source_1"] == "s"


def _deliveries(spark, root, **limits):
    return arrivals.process_deliveries(
        spark, f"{root}/incoming", f"{root}/processed", f"{root}/results", f"{root}/ledger", "now", **limits
    )


def _latest(spark, root):
    return {r["customerID"]: r["MonthlyCharges"] for r in arrivals.read_latest(spark, f"{root}/processed", f"{root}/ledger").collect()}


def test_a_file_delivered_again_replaces_its_rows(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    assert arrivals.read_ledger(spark, f"{tmp_path}/ledger").count() == 0
    assert _deliveries(spark, tmp_path) == 0 and _latest(spark, tmp_path) == {}
    (incoming / "a b+%20%.csv").write_text("customerID,MonthlyCharges\nk1,5\nk2,6\n")
    (incoming / "c.csv").write_text("customerID,MonthlyCharges\nk3,7\n")
    (incoming / "bad.csv").write_text(BROKEN)
    assert _deliveries(spark, tmp_path, files_per_batch=2) == 2
    assert _latest(spark, tmp_path) == {"k1": "5", "k2": "6", "k3": "7"}
    assert _deliveries(spark, tmp_path) == 0
    # Same path: new contents, then a mended one, then one without the key.
    (incoming / "a b+%20%.csv").write_text("customerID,MonthlyCharges,Extra\nk1,50,x\n")
    (incoming / "bad.csv").write_text("customerID,MonthlyCharges\nk4,8\n")
    assert _deliveries(spark, tmp_path) == 1
    assert _latest(spark, tmp_path) == {"k1": "50", "k3": "7", "k4": "8"}
    (incoming / "c.csv").write_text(BROKEN)
    assert _deliveries(spark, tmp_path) == 1
    assert _latest(spark, tmp_path) == {"k1": "50", "k3": "7", "k4": "8"}
    told = [(r["source_file"].rsplit("/", 1)[1], r["status"]) for r in arrivals.read_results(spark, f"{tmp_path}/results").collect()]
    assert sorted(s for _, s in told) == ["FAILED"] * 2 + ["SUCCESS"] * 4
    ledger = arrivals.read_ledger(spark, f"{tmp_path}/ledger")
    assert ledger.count() == 6 and ledger.select("batch").distinct().count() == 4


def test_a_batch_that_broke_off_is_done_again(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (incoming / "x.csv").write_text("customerID,MonthlyCharges\nk1,5\n")
    # Rows and results were written, the ledger was not; then another file came.
    arrivals._process(spark, [f"file:{incoming}/x.csv"], f"{tmp_path}/processed", f"{tmp_path}/results", 1, "before")
    (incoming / "y.csv").write_text("customerID,MonthlyCharges\nk2,6\n")
    assert _deliveries(spark, tmp_path) == 1
    assert _latest(spark, tmp_path) == {"k1": "5", "k2": "6"}
    stored = arrivals.read_processed(spark, f"{tmp_path}/processed")
    assert stored.count() == 2 and {r[0] for r in stored.select("auto_processed_at").collect()} == {"now"}
