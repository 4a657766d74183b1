import math

import pytest

from pyspark.sql import functions as F

from kinloom.operators import blocking as B
from kinloom.plans import measures as M
from kinloom.plans import validate as V
from kinloom.plans.run import Settings, blocking_run
from kinloom.sources import tsv
from kinloom.streaming.probe import probe_stream, write_candidates


def entries(spark, spec):
    rows = [(probe, key, src, f"S{src}-{key}-{i}") for probe, key, n2, n3 in spec for src, n in ((2, n2), (3, n3)) for i in range(n)]
    return spark.createDataFrame(rows, "probe string, key string, src int, entity_id string")


def test_caps(spark):
    e = entries(spark, [("name", "a", 6, 2), ("name", "b", 3, 3), ("name", "c", 2, 2), ("city", "d", 2, 1), ("city", "e", 2, 2), ("city", "f", 6, 2)])
    kept = B.capped_index(e, max_bucket=5, city_cap=3).groupBy("key", "src").count().collect()
    assert {(r["key"], r["src"]): r["count"] for r in kept} == {("a", 3): 2, ("c", 2): 2, ("c", 3): 2, ("d", 2): 2, ("d", 3): 1, ("f", 3): 2}
    report = B.dropped_keys(B.bucket_sizes(e), 5).first()
    assert (report.dropped_s2, report.dropped_s3, report.dropped_merged, report.keys_kept) == (2, 0, 1, 5)


def records(spark, rows):
    return spark.createDataFrame(rows, "k long, src int, entity_id string, business_name string, business_address string, country string")


def test_run_keeps_every_named_row(spark):
    rows = records(
        spark,
        [(1, 1, "S1-1", "Acme Robotics", "5 A St, X", "US"), (2, 1, "S1-1", "Acme Robotics", "", "US"), (3, 1, " ", "Acme", "", "US"), (4, 1, "S1-4", "Zzz", "", "FR"),
         (5, 2, "S2-9", "Robotics Acme", "", "us"), (6, 2, "S2-10", "Acme Ltd", "", "US"), (7, 3, "X3-1", "Acme", "", "US"), (8, 3, None, "Acme", "", "US"), (9, 3, "S3-1", "Other", "5 B Rd, Y", "US")],
    )
    reference = rows.where("src = 1")
    lists = blocking_run(reference, rows.where("src > 1"), "k", Settings())
    got = {r.k: r.candidate_entity_ids for r in lists.collect()}
    assert got == {1: "S2-10,S3-1", 2: "S2-10", 4: ""}
    stats = B.run_stats(reference, lists).first()
    assert (stats.rows, stats.candidates, stats.most, stats.errors) == (3, 3, 2, 1)


def test_larger_caps_only_add(spark, sf):
    from kinloom.plans.queries import _pairs

    small = _pairs(spark, sf, 100, 10)[1]
    large = _pairs(spark, sf, 100, 10**9)[1]
    assert small.join(large, ["k", "entity_id", "cand"], "left_anti").count() == 0


def large_sides(spark, repeated):
    names = ["Acme Tools", "Acme Toys", "Ace Tools", "Zed", "", "Acme"]
    one = lambda src, i: (i, src, f"S{src}-{i}", names[(i + src) % 6], f"{i % 4} Road, {'AB'[i % 2]}" if i % 5 else "", "US")
    reference, others = [one(1, i) for i in range(30)], [one(2 + i % 2, i) for i in range(50)]
    others += [(90, 2, "S1-3", "Acme", "", "US"), (91, 3, "S1-3", "Acme", "", "US")]  # an id of the reference
    if repeated:  # ids with several records, one of them without any telling part
        reference += [(3, 1, "S1-3", "Zed", "7 Road, B", "US"), (4, 1, "S1-4", "", "", "US"), (98, 1, "S1-5", "Zed", "", "US")]
        others += [(92, 2, "S2-4", "Zed", "3 Road, A", "US"), (93, 2, "S2-6", "", "", "US"), (94, 2, "S2-6", "Zed Zed", "", "US")]
    reference, others = records(spark, reference), records(spark, others)
    return reference, B.capped_index(B.index_entries(others), 10**9, None)


@pytest.mark.parametrize("cell", [2, 1024])
@pytest.mark.parametrize("repeated", [False, True])
def test_all_pairs_equal_candidate_pairs(spark, monkeypatch, repeated, cell):
    monkeypatch.setattr(B, "CELL", cell)
    reference, index = large_sides(spark, repeated)
    rows = lambda df: sorted(map(tuple, df.collect()))
    got = rows(B.all_pairs(reference, index, (), "k", "entity_id"))
    assert len(got) > 500 and got == rows(B.candidate_pairs(reference, index, (), "k", "entity_id"))


@pytest.mark.parametrize("cell, wide", [(2, 3), (3, 2), (1024, 3), (2, 8192)])
@pytest.mark.parametrize("repeated", [False, True])
def test_all_pairs_leave_the_join_as_arrays(spark, monkeypatch, repeated, cell, wide):
    monkeypatch.setattr(B, "CELL", cell)
    monkeypatch.setattr(B, "WIDE", wide)
    reference, index = large_sides(spark, repeated)
    found = B.all_pairs(reference, index, (), "k", "entity_id")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(found) == rows(B.candidate_pairs(reference, index, (), "k", "entity_id"))
    # Ids are told apart only above the join, which meets a query with arrays of them.
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert "explode(cands" in above


@pytest.mark.parametrize("repeated", [False, True])
def test_pair_counts_equal_pairs(spark, repeated):
    reference, index = large_sides(spark, repeated)
    want = {}
    for r in B.candidate_pairs(reference, index, (), "k", "entity_id").collect():
        want.setdefault(r.entity_id, []).append(r.cand)
    got = {r.entity_id: (r.n, r.first_cand, r.last_cand) for r in B.pair_counts(reference, index, (), "k", "entity_id").collect()}
    assert got == {k: (len(v), min(v), max(v)) for k, v in want.items()}


def test_uncapped_counts_make_no_pair(spark, sf, monkeypatch):
    from kinloom.plans.queries import candidates_uncapped

    for name in ("candidate_pairs", "all_pairs", "_meet"):
        monkeypatch.setattr(B, name, None, raising=False)
    assert candidates_uncapped(spark, sf).count() > 0


def test_uncapped_pairs_are_made_once(spark, sf):
    from kinloom.plans.queries import candidates_city_cap

    plan = candidates_city_cap(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Aggregate" not in plan.split("Join Inner")[0]


@pytest.mark.parametrize("max_bucket", [None, 3])
def test_self_counts_equal_pairs(spark, max_bucket):
    names = ["Acme Tools", "Acme Toys", "Ace Tools", "Zed", "", "Acme"]
    rows = [(i, 1, f"S1-{i}", names[i % 6], f"{i % 4} Road, {'AB'[i % 2]}" if i % 5 else "", "US") for i in range(40)]
    for given in (rows, [*rows, (99, 1, "S1-3", "Other", "", "FR")]):
        df = records(spark, given)
        pairs = [(r.a, r.b) for r in B.self_pairs(df, city_cap=9, max_bucket=max_bucket).collect()]
        assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
        want = {}
        for x, y in [*pairs, *((b, a) for a, b in pairs)]:
            want.setdefault(x, []).append(y)
        got = {r.entity_id: (r.n, r.first_cand, r.last_cand) for r in B.self_counts(df, city_cap=9, max_bucket=max_bucket).collect()}
        assert got == {k: (len(v), min(v), max(v)) for k, v in want.items()}


def test_f_half_worked_example(spark):
    schema = "source1_entity_id string, matched_entity_ids string"
    truth = spark.createDataFrame([("S1-1", "S2-00047,S3-00812"), ("S1-2", ""), ("S1-3", None), ("S1-4", "S2-1")], schema)
    predicted = spark.createDataFrame([("S1-1", "S2-00047,S2-00193,S3-00812"), ("S1-2", ""), ("S1-3", "S2-5"), ("S1-4", "S2-2")], schema)
    got = {r.source1_entity_id: r.f for r in M.entity_scores(truth, predicted).collect()}
    assert math.isclose(got["S1-1"], 0.714, abs_tol=5e-4)
    assert (got["S1-2"], got["S1-3"], got["S1-4"]) == (1.0, 0.0, 0.0)


def test_readers(spark, tmp_path):
    path = str(tmp_path / "source1.tsv")
    with open(path, "wb") as f:
        f.write(b'entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A ""B"""\t"x\ny"\tUS\nS1-2\tNA\t\tnull\n \tblank\t\t\nS1-3\tshort\n')
    rows = {r.entity_id: r for r in tsv.read_records(spark, path).collect()}
    assert rows["S1-1"].business_name == 'A "B"' and rows["S1-1"].business_address == "x\ny"
    assert (rows["S1-2"].business_name, rows["S1-2"].business_address, rows["S1-2"].country) == ("NA", "", "null")
    assert rows["S1-3"].country == ""
    found, missing = tsv.read_sources(spark, str(tmp_path))
    assert set(found) == {"source1"} and missing == ["source2", "source3"]
    raw = str(tmp_path / "raw.tsv")
    with open(raw, "w") as f:
        f.write('entity_id\tbusiness_name\nS2-1\t"quo\n\tnone\nS2-2\n')
    assert [(r.entity_id, r.business_name) for r in tsv.read_raw_records(spark, raw).orderBy("line").collect()] == [("S2-1", '"quo'), ("S2-2", "")]


def test_id_lists(spark, tmp_path):
    path = str(tmp_path / "m.tsv")
    with open(path, "w") as f:
        f.write("source1_entity_id\tMatched_entity_ids \nS1-1\tS2-1,S2-1\nS1-1\tS2-2\textra\nbad line\n\nS1-2\t \nS1-9\tS1-1,X1,S2-404\n")
    rows, errors, bad = tsv.read_id_lists(spark, path, tsv.MATCH_HEADER)
    assert errors == [] and bad.count() == 1 and bad.first().message.endswith("line 4")
    got = [(r.s1, r.ids) for r in rows.orderBy("line").collect()]
    assert got == [("S1-1", "S2-1,S2-1"), ("S1-1", "S2-2\textra"), ("S1-2", " "), ("S1-9", "S1-1,X1,S2-404")]
    required = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1 string")
    valid = spark.createDataFrame([("S2-1",), ("S2-2\textra",)], "id string")
    found = {r.check: r.examples for r in V.findings(rows, required, valid).collect()}
    assert found == {"duplicate_rows": "S1-1", "repeated_ids": "S1-1", "self_matches": "S1-1", "wrong_prefix": "X1", "unknown_ids": "S2-404", "missing": "S1-3", "extra": "S1-9"}
    assert V.file_summary(rows).first() == (4, 1, 3)
    assert {(r.s1, r.ids) for r in V.last_rows(rows, "line").collect()} == set(got[1:])
    assert tsv.read_id_lists(spark, str(tmp_path / "none.tsv"), tsv.MATCH_HEADER)[1]
    for text in ("", "source1_entity_id,matched_entity_ids\n", "a\tb\n"):
        (tmp_path / "w.tsv").write_text(text)
        assert len(tsv.read_id_lists(spark, str(tmp_path / "w.tsv"), tsv.MATCH_HEADER)[1]) == 1


def test_ids_targets_and_utf8(spark, tmp_path):
    (tmp_path / "test_source2.tsv").write_text("entity_id\tn\n S2-1 \tx\n\nS2-1\ty\n")
    assert tsv.read_targets(spark, str(tmp_path))[0] is None
    (tmp_path / "test_source3.tsv").write_text("entity_id\nS3-1\n")
    assert sorted(r.id for r in tsv.read_targets(spark, str(tmp_path))[0].collect()) == ["S2-1", "S3-1"]
    (tmp_path / "bytes.tsv").write_bytes(b"ok\nb\xffd\n")
    assert tsv.invalid_lines(spark, str(tmp_path / "bytes.tsv")).count() == 1


def test_sink_round_trip(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", "S2-1,S3-2"), ("S1-2", "")], "entity_id string, candidate_entity_ids string")
    tsv.write_lists(lists.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text == "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n"
    tsv.write_lists(lists.coalesce(1), str(tmp_path / "bare"), header=False)
    check = V.output_check(spark.read.text(str(tmp_path / "bare"))).first()
    assert (check.total, check.s1_ok, check.empty, check.s23_only, check.bad_col, check.bad_prefix) == (2, 2, 1, True, 0, 0)


def test_truth_and_simple_check(spark, tmp_path):
    (tmp_path / "gt.tsv").write_text("a\tb\nS1-1\tS2-1\nS1-2\nS1-3\t \n")
    truth = tsv.read_truth(spark, str(tmp_path / "gt.tsv"))
    assert V.summary(truth, "matched_entity_ids").first() == (3, 1, 2)
    rows = spark.createDataFrame([(None, "x"), (None, ""), ("a", None)], "entity_id string, matches string")
    assert tuple(V.simple_check(rows, "entity_id", "matches").first()) == (True, 1, 3, 2, 1)
    assert V.simple_check(rows.withColumn("z", F.lit(1)), "entity_id", "matches").first().columns_ok is False


def test_streaming_probe(spark, tmp_path, sf):
    from kinloom.plans.queries import _entries, _sides

    reference, index, stops = _entries(spark, sf)
    live = B.capped_index(index, 100, 40).cache()
    reference.select("entity_id", "business_name", "business_address", "country").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("entity_id string, business_name string, business_address string, country string").parquet(str(tmp_path / "in"))
    write_candidates(stream, live, str(tmp_path / "out"), str(tmp_path / "check"), stops).awaitTermination()
    got = {r.entity_id: r.candidate_entity_ids for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = B.candidate_lists(reference, B.candidate_pairs(reference, live, stops), "entity_id")
    assert got == {r.entity_id: r.candidate_entity_ids for r in batch.collect()}
    q = probe_stream(stream, live, stops).writeStream.format("memory").queryName("probed").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("probed").select("entity_id", "cand").distinct().count() == B.candidate_pairs(reference, live, stops).count()


def test_commands(spark, tmp_path, capsys):
    from kinloom.__main__ import main

    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    (tmp_path / "test_source1.tsv").write_text(head + "S1-1\tAcme Tools\t5 A St, X\tUS\n \tnobody\t\tUS\nS1-2\tZed\t\tFR\nS1-1\tAcme\t\tUS\n")
    (tmp_path / "test_source2.tsv").write_text(head + 'S2-9\t"Acme ""Q"" Tools"\t\tus\nS2-10\tOther\t5 B St\tUS\n')
    (tmp_path / "test_source3.tsv").write_text(head + "S3-1\tAcme Ltd\t\tUS\nX9\tAcme\t\tUS\n")
    sources = [x for i in (1, 2, 3) for x in (f"--s{i}", str(tmp_path / f"test_source{i}.tsv"))]
    assert main(["block", *sources, "--out", str(tmp_path / "out")]) == 0
    said = capsys.readouterr().out
    assert "rows written: 3, without id: 1" in said and "records indexed from source 2: 2" in said
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [x for x in text.split("\n") if x and not x.startswith("source1")] == ["S1-1\tS2-10,S2-9,S3-1", "S1-2\t", "S1-1\tS2-9,S3-1"]
    assert main(["block", *sources, "--out", str(tmp_path / "bare"), "--no-header", "--s1-limit", "1"]) == 0
    assert "".join(p.read_text() for p in (tmp_path / "bare").glob("part-*")) == "S1-1\tS2-10,S2-9,S3-1\n"
    (tmp_path / "test_source1.tsv").write_text(head + "S1-1\tAcme\n\nS1-2\tZed\n")
    (tmp_path / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9\nS1-2\t\n")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS3-1\nS1-2\t\n")
    assert main(["validate", "-m", str(tmp_path / "m.tsv"), "-c", str(tmp_path / "c.tsv"), "-t", str(tmp_path)]) == 0
    said = capsys.readouterr().out
    assert "WARNING matching outside_candidates: 1 (S1-1)" in said and "passed" in said
    (tmp_path / "m.tsv").write_bytes(b"source1_entity_id\tmatched_entity_ids\nS1-1\tS2-404\nno tab\nS1-2\t\xff\n")
    assert main(["validate", "-m", str(tmp_path / "m.tsv"), "-t", str(tmp_path)]) == 1
    said = capsys.readouterr().out
    assert all(x in said for x in ("not_utf8: 1", "malformed_lines: 1 (3)", "unknown_ids: 1 (S2-404)", "no_candidates", "failed"))
    assert main(["validate", "-m", str(tmp_path / "m.tsv"), "-t", str(tmp_path / "nowhere"), "--no-check-ids"]) == 1
    assert main(["check", str(tmp_path / "bare")]) == 0
    assert main(["check", str(tmp_path / "m.tsv")]) == 0
    assert "prefix source1_entity_id" in capsys.readouterr().out
