import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from conftest import TEXTS, twice
from kinloom.llm import apportion, arc_convert, chat_quotes, common, decontaminate, graph, interpolated_lm, jaccard_join, license_scan, quality_fm, quality_ratio, secret_ledger
from kinloom.llm.queries import queries

ODD = [(r[0], r[1]) for r in TEXTS]


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


# 4: Jaccard join


def test_jaccard_equals_brute_force(spark, sf, texts):
    got = by_id(queries()["op4_jaccard_join"](spark, sf), "n_shingles", "component_id", "n_links")
    assert got == brute.jaccard_groups(texts)


def near_copies(n=40):
    words = [f"w{i}" for i in range(120)]
    out = [(0, " ".join(words))]
    for i in range(1, n):
        own = list(words)
        for j in range(i % 4):
            own[(i * 7 + j * 29) % 120] = f"edit{i}x{j}"
        out.append((i, " ".join(own)))
    return out


@pytest.mark.parametrize(("broadcast", "split"), [(1_000_000, 1024), (0, 1024), (1_000_000, 3)])
def test_jaccard_group_of_near_copies(spark, monkeypatch, broadcast, split):
    monkeypatch.setattr(jaccard_join, "SPLIT", split)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(jaccard_join.jaccard_groups(df, bits=8, most_broadcast=broadcast), "n_shingles", "component_id", "n_links")
    assert got == brute.jaccard_groups(rows)


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_jaccard_near_copies_of_rows_without_id(spark, broadcast):
    a, b = ([f"{x}{i}" for i in range(120)] for x in "ab")
    rows = [(None, " ".join(a)), (None, " ".join(a)), (5, " ".join(a)), (7, " ".join([*a[:-1], "edit"])), (None, " ".join(b)), (9, " ".join([*b[:-1], "edit"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = Counter((r.doc_id, r.component_id, r.n_links) for r in jaccard_join.jaccard_groups(df, bits=8, most_broadcast=broadcast).collect())
    assert got == Counter({(None, 5, 3): 2, (5, 5, 3): 1, (7, 5, 3): 1, (None, 9, 1): 1, (9, 9, 1): 1})


@pytest.mark.parametrize(("k", "percent", "split"), [(5, 80, 1024), (3, 90, 1024), (5, 80, 5)])
def test_groups_without_all_pairs_equal_brute_force(spark, monkeypatch, texts, k, percent, split):
    monkeypatch.setattr(jaccard_join, "SPLIT", split)
    rows = [*texts, *((10_000 + i, t) for i, t in near_copies(120)), *((20_000 + i, " ".join(f"chain{j}" for j in range(4 * i, 4 * i + 60))) for i in range(40))]
    want = {i: c for i, (n, c, _) in brute.jaccard_groups(rows, k, percent).items() if n}
    feats, grouped = jaccard_join.near_copy_groups(spark.createDataFrame(rows, "doc_id long, text string"), k, percent, 10, 1000)
    least = grouped.groupBy("root").agg(F.min("label").alias("c"))
    got = by_id(feats.join(grouped.join(least, "root").select("digest", "c"), "digest"), "c")
    assert {i: c for i, (c,) in got.items()} == want


def test_a_cluster_is_not_paired_with_itself(spark):
    """300 different near copies: pivots hold them together, and no pair is left to make."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*words[:i], f"edit{i}", *words[i + 1 :]])) for i in range(300)]
    made = []
    finely, jaccard_join._finely = jaccard_join._finely, lambda joined, reps, percent: (made.append(joined.count()), finely(joined, reps, percent))[1]
    try:
        _, grouped = jaccard_join.near_copy_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 10, 1000)
        assert grouped.select("root").distinct().count() == 1
    finally:
        jaccard_join._finely = finely
    assert made[0] <= 300 * 81 and made[1] == 0


def test_near_copies_go_row_by_row(spark):
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    near = lambda w: " ".join([*w[:-1], "edit"])
    rows = [(None, " ".join(a)), (7, near(a)), (7, " ".join(b)), (7, " ".join(b)), (3, " ".join(a)), (None, near(b)), (None, None), (9, ""), (9, ""), (None, "lone words here"), (None, "lone words here")]
    want = [(None, "None"), (None, "lone words here"), (3, " ".join(a)), (7, " ".join(b)), (9, ""), (9, "")]
    for order in (rows, rows[::-1], rows[5:] + rows[:5]):
        for broadcast in (500_000, 0):
            df = spark.createDataFrame([(*r, "own") for r in order], "doc_id long, text string, row string").coalesce(1)
            left = jaccard_join.without_near_copies(df, bits=8, most_broadcast=broadcast)
            assert left.columns == df.columns
            assert sorted(((r.doc_id, str(r.text)) for r in left.collect()), key=str) == sorted(want, key=str)


def test_jaccard_odd_rows(odd, none):
    got = by_id(jaccard_join.jaccard_groups(odd), "n_shingles", "component_id", "n_links")
    assert got == brute.jaccard_groups(ODD)
    assert jaccard_join.jaccard_groups(none).count() == 0
    rows = jaccard_join.jaccard_groups(twice(odd)).collect()
    assert len(rows) == 2 * len(ODD) + 1
    assert {(r.component_id, r.n_links) for r in rows if r.doc_id in (12, 13, None)} == {(12, 4)}
    assert [r.n_links for r in rows if r.doc_id == 4] == [0, 0]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(20)} | {200: 200, 201: 200}


# 6: secrets


def test_secrets_equal_brute_force(spark, sf, texts, odd, none):
    for df, rows in ((queries()["op6_secret_ledger"](spark, sf), texts), (secret_ledger.scan_secrets(odd)[0], ODD)):
        got = by_id(df, "n_assign", "n_access", "n_hex", "base_sha256")
        assert got == {i: brute.secrets(t)[:4] for i, t in rows}
    assert secret_ledger.scan_secrets(none)[0].count() == 0
    assert len(secret_ledger.scan_secrets(twice(odd))[0].collect()) == 2 * len(ODD) + 1


def test_method_spans_add_to_the_base(spark):
    text = "x eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK token=abcdef\n-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----"
    r = secret_ledger.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0].first()
    assert r.base_sha256 == brute.secrets(text)[3]
    assert [x.split(":")[0] for x in r.spans.split(",")] == ["jwt", "assign", "private"]


def test_ledger_scans_only_what_is_new(spark, odd):
    rules = dict(secret_ledger.BASE)
    _, ledger = secret_ledger.scan_secrets(odd, rules=rules)
    again = secret_ledger.update_ledger(odd, ledger, rules)
    assert again.count() == 0
    newer = rules | {"hex": (2, rules["hex"][1], 0, 32)}
    delta = secret_ledger.update_ledger(odd, ledger, newer)
    assert {(r.rule, r.version) for r in delta.collect()} == {("hex", 2)}
    more = odd.unionByName(odd.where("doc_id = 12").withColumn("doc_id", F.lit(99).cast("long")).withColumn("text", F.lit("secret = hunter22")))
    assert {r.rule for r in secret_ledger.update_ledger(more, ledger, rules).collect()} == set(rules)
    found = by_id(secret_ledger.scan_secrets(more, ledger, rules)[0], "n_assign", "n_hex")
    assert found[99] == (1, 0) and found[12] == (2, 1)


def test_a_stored_ledger_grows_by_what_is_new(spark, odd, none, tmp_path):
    path = f"file://{tmp_path}/ledger"
    assert secret_ledger.stored_ledger(spark, path) is None
    half = odd.where("doc_id < 7")
    first = secret_ledger.run_ledger(half, path).count()
    assert first == len({t or "" for i, t in ODD if i < 7}) * len(secret_ledger.RULES)
    after = secret_ledger.run_ledger(odd, path)
    assert after.count() == len({t or "" for _, t in ODD}) * len(secret_ledger.RULES) == after.distinct().count()
    assert secret_ledger.run_ledger(twice(odd), path).count() == after.count() == secret_ledger.run_ledger(none, path).count()
    got = by_id(secret_ledger.findings_by_row(odd, after), "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == {i: brute.secrets(t)[:4] for i, t in ODD}
    assert secret_ledger.run_ledger(none, f"file://{tmp_path}/none").count() == 0


@pytest.mark.parametrize("few", [10_000, 0])
def test_findings_do_not_depend_on_the_join(odd, monkeypatch, few):
    monkeypatch.setattr(secret_ledger, "FEW", few)
    monkeypatch.setattr(secret_ledger, "MOST_BYTES", few)
    assert by_id(secret_ledger.scan_secrets(odd)[0], "n_assign", "n_access", "n_hex", "base_sha256") == {i: brute.secrets(t)[:4] for i, t in ODD}
    clash = odd.withColumnRenamed("size", "_blob").withColumnRenamed("score", "_spans")
    assert secret_ledger.mask_secrets(clash).columns == clash.columns


def test_private_keys_are_whole():
    blocks = [
        "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A\n\nabc+/=\n-----END RSA PRIVATE KEY-----",
        "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\nabc\n=Zz\n-----END PGP PRIVATE KEY BLOCK-----",
        "-----BEGIN PRIVATE KEY-----",
    ]
    text = "x\n" + "\nbetween\n".join(blocks)
    assert [text[a:b] for a, b in secret_ledger.spans(text, secret_ledger.RULES, "private")] == blocks
    assert len(secret_ledger.spans(blocks[2] * 20_000, secret_ledger.RULES, "private")) == 20_000


def test_masking(odd):
    rows = {r.doc_id: r for r in secret_ledger.mask_secrets(odd).collect()}
    assert rows[12].text == "[assign] [assign]' token=abc [access] [hex]" and rows[12].n_chars == len(rows[12].text)
    assert rows[1].text == ODD[0][1] and rows[3].text is None and rows[12].spans == "own spans"
    assert len(rows) == len(ODD)


# 8: quality rules


def test_quality_counts_and_ratio_equal_brute_force(spark, sf, texts):
    got = queries()["op8_quality_rules"](spark, sf).collect()
    good = {r.doc_id for r in common.table(spark, sf, "labels").where("quality = 1").collect()}
    known = brute.ratios(texts, good)
    want = {i: (*brute.rule_counts(t), brute.verdict(t, known, quality_ratio.THRESHOLD)) for i, t in texts}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {r.doc_id: tuple(r[c] for c in names) for r in got} == want


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 1), (None, 1), (7, None), (500, 1)], "doc_id long, quality int")
    ratios = quality_ratio.fit_ratio(odd, labels)
    out = quality_ratio.judge_quality(odd, ratios)
    got = {r.doc_id: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in out.collect()}
    assert got == {i: brute.rule_counts(t) for i, t in ODD}
    assert out.where("text is null").first().score == 0.0
    assert quality_ratio.fit_ratio(none, labels) == [0] * (1 << quality_ratio.BITS)
    assert set(quality_ratio.fit_ratio(odd, labels.limit(0))) == {0}
    assert quality_ratio.judge_quality(none, ratios).count() == 0
    assert quality_ratio.judge_quality(twice(odd), ratios).count() == 2 * len(ODD) + 1


# 7: mixing


def check_mix(rows, slack):
    by = Counter()
    for r in rows:
        by[r.source] += r.size
    want = brute.targets(dict(by))
    taken = Counter()
    for r in rows:
        assert r.source_size == by[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in by:
        assert abs(taken[s] - want[s]) <= slack + 0.01 * want[s], (s, taken[s], want[s])


def test_mix(spark, sf, texts, odd, none):
    rows = queries()["op7_mix_sources"](spark, sf).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len(brute.words(t)) for i, t in texts}
    check_mix(rows, 40)
    again = queries()["op7_mix_sources"](spark, sf).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    rows = apportion.mix_sources(odd, block_words=1).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len(brute.words(t)) for i, t in ODD}
    check_mix(rows, 3)
    check_mix(apportion.mix_sources(twice(odd), block_words=4, docs_per_shard=3).collect(), 40)
    assert apportion.mix_sources(none).count() == 0
    blank = apportion.mix_sources(odd.where("doc_id in (3, 4, 5)")).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 3


def test_mix_spreads_rows_without_id(spark):
    rows = [(None, f"t{i} " * (i + 1), "a", i) for i in range(60)] + [(None, None, "a", None), (None, "t3 " * 4, "a", 1), (5, "x y", "b", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    assert df.select(apportion.draw("mix").alias("d")).distinct().count() == 62
    got = apportion.mix_sources(df, docs_per_shard=4, block_words=2).collect()
    check_mix(got, 20)
    again = apportion.mix_sources(df.orderBy(F.desc("n")), docs_per_shard=4, block_words=2).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_block_by_block(texts, docs):
    """Every block of every shard laid out and drawn one by one."""
    draw = lambda *x: hashlib.md5("|".join(["mix", *map(str, x)]).encode()).hexdigest()
    per_shard, size = 40, 16
    rows = [(r.doc_id, r.source, len(brute.words(r.text))) for r in docs.collect()]
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sizes = {s: sum(r[2] for r in v) for s, v in by.items()}
    key = lambda s: "null" if s is None else f"={s}"
    target = brute.targets(sizes)
    blocks = brute.sainte_lague({key(s): t for s, t in target.items()}, round(sum(sizes.values()) / size))
    want = {}
    for s, own in by.items():
        shards = {}
        n = -(-len(own) // per_shard)
        for r in own:
            shards.setdefault(int(draw(r[0])[:12], 16) % n, []).append(r)
        quota = brute.sainte_lague({k: float(sum(r[2] for r in v)) for k, v in shards.items()}, blocks[key(s)])
        for k, members in shards.items():
            members.sort(key=lambda r: (draw(r[0]), r[0], r[2]))
            holders = [r[0] for r in members for _ in range(r[2])]
            nb = -(-len(holders) // size)
            if not nb:
                continue
            times, more = divmod(min(quota[k], 3 * nb), nb)
            start = int(draw(key(s), k)[:12], 16) % nb
            for b in range(nb):
                picked = times + ((b + 1) * more + start) // nb - (b * more + start) // nb
                for h in holders[b * size : (b + 1) * size]:
                    want[h] = want.get(h, 0) + picked
    got = by_id(apportion.mix_sources(docs, docs_per_shard=per_shard), "taken")
    assert {i: t for i, (t,) in got.items()} == {r[0]: want.get(r[0], 0) for r in rows}


@pytest.mark.parametrize(("votes", "seats"), [([53.0, 24.0, 23.0], 10), ([1.0] * 7, 3), ([0.0, 5.0, 5.0], 9), ([1000.0, *[0.49] * 40], 30), ([10.0, 20.0], 0), ([0.0, 0.0], 5)])
def test_sainte_lague(spark, votes, seats):
    df = spark.createDataFrame([(k, v, seats) for k, v in enumerate(votes)], "id long, votes double, seats long")
    got = {r.id: r.won for r in apportion.sainte_lague(df, [], "id", "votes", "seats", "won").collect()}
    assert got == brute.sainte_lague(dict(enumerate(votes)), seats)


# 9: language model


def test_language_model_equals_brute_force(texts, docs):
    want = brute.language_model(texts)
    for sizes in ({}, {"chunk_tokens": 3000, "part_keys": 2000}, {"chunk_tokens": 3000, "part_keys": 4000, "fan_bits": 2}):
        got = by_id(interpolated_lm.score_texts(docs, **sizes), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
        assert got.keys() == want.keys()
        for i, w in want.items():
            assert got[i][:4] == w[:4]
            assert math.isclose(got[i][4], w[4], rel_tol=1e-9)
            assert math.isclose(got[i][5], w[5], rel_tol=2e-3)
    held = [g for g in got.values() if g[0]]
    assert sum(g[5] for g in held) > sum(g[4] for g in held)


def test_messages_grow_with_the_corpus(spark, texts):
    """Twice the chunks send about twice the messages, on every level."""
    rows = [(i, t) for i, t in texts if i % 3 == 0]

    def messages(copies):
        df = spark.createDataFrame([(i + 1000 * c, f"{t} {c}") for c in range(copies) for i, t in rows], "doc_id long, text string").coalesce(1)
        seen = []
        settle, interpolated_lm.settle = interpolated_lm.settle, lambda x, label: (seen.append((label, y := settle(x, label))), y)[1]
        try:
            interpolated_lm.score_texts(df, chunk_tokens=500, part_keys=500, fan_bits=2).count()
        finally:
            interpolated_lm.settle = settle
        return sum(x.count() for label, x in seen if label in ("sent", "counts"))

    small, large = messages(2), messages(4)
    assert large <= 2.6 * small


def test_language_model_odd_rows(odd, none):
    want = brute.language_model(ODD)
    got = by_id(interpolated_lm.score_texts(odd), "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    assert {i: g[:4] for i, g in got.items()} == {i: w[:4] for i, w in want.items()}
    assert all(math.isclose(g[4], want[i][4], rel_tol=1e-9) for i, g in got.items())
    assert interpolated_lm.score_texts(none).count() == 0
    assert interpolated_lm.score_texts(twice(odd)).count() == 2 * len(ODD) + 1
    held = odd.where("crc32(cast(cast(doc_id as string) as binary)) % 10 = 0")
    assert [r.train_tokens for r in interpolated_lm.score_texts(held).collect()] == [0] * held.count()


# 1: decontamination


def test_leaks(spark, docs, sf):
    items = [(i, " ".join(f"item{i}w{j * j % 61}" for j in range(30))) for i in range(3)] + [(8, None), (9, " .,"), (10, "short one"), (0, " ".join(f"item0w{j * j % 61}" for j in range(30)))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
    exact = items[0][1].split()
    edited = list(items[1][1].split())
    edited[5], edited[17] = "other", "word"
    del edited[11]
    far = [w if j % 3 else f"z{j}" for j, w in enumerate(items[2][1].split())]
    pad = [f"pad{j}" for j in range(400)]
    rows = [(1, " ".join(pad + exact + pad)), (1, " ".join(pad + exact + pad)), (2, " ".join([*pad, *edited, "end."]).upper()), (3, " ".join(far)), (4, " ".join(pad)), (5, None), (6, ""), (7, "A short, one!"), (None, " ".join(exact))]
    got = {(r.doc_id, r.item_id): round(r.score, 3) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (7, 10), (None, 0)}
    assert got[1, 0] == 1.0 and 0.8 < got[2, 1] < 1.0
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    rows += [(None, "clean"), (1, "clean too"), (7, "a clean one")]
    left = decontaminate.without_leaks(spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("own")), bench)
    assert left.columns == ["doc_id", "text", "row"]
    assert sorted((r.doc_id or 0, (r.text or "")[:7]) for r in left.collect()) == [(0, "clean"), (1, "clean t"), (3, rows[3][1][:7]), (4, "pad0 pa"), (5, ""), (6, ""), (7, "a clean")]


def test_common_passage_is_still_found(spark):
    item = " ".join(f"q{j}" for j in range(25))
    rows = [(i, f"lead{i} {item} tail{i}") for i in range(300)]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(4, item)], "item_id long, text string"))
    assert got.count() == 300


@pytest.mark.parametrize("every", [4, 5])
def test_an_edited_item_in_many_copies_is_found(spark, every):
    item = [f"q{j}" for j in range(40)]
    edited = [f"edit{j}" if j % every == every - 1 else w for j, w in enumerate(item)]
    rows = [(i, " ".join([f"lead{i}", *edited, f"tail{i}"])) for i in range(1000)] + [(5000, " ".join(item))]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(4, " ".join(item))], "item_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows}


def test_seeds_are_the_rarest_and_lose_nothing(spark):
    """Items that open with a stock phrase, which every document holds."""
    stock = [f"stock{j}" for j in range(8)]
    items = [[*stock, *(f"i{i}w{j}" for j in range(40))] for i in range(12)]
    edited = [[w if j % 4 else f"e{j}" for j, w in enumerate(item)] for item in items]
    rows = [(i, " ".join([*stock, f"lead{i}", *edited[i % 12], f"tail{i}", *stock] if i % 2 else [*stock, *(f"c{i}w{j}" for j in range(60)), *stock])) for i in range(48)]
    df = spark.createDataFrame([*rows, (99, None), (98, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    want = {(i, j) for i, t in rows for j, item in enumerate(items) if decontaminate.align([x.encode() for x in item], t.encode().split())[0] >= 0.6 * 2 * len(item)}
    assert len(want) == 24 and got == want
    found, passages = decontaminate.passages_of(df, bench, 3, 0.6)
    hits = passages.select("pid", "class", F.explode("grams").alias("gram"))
    frequent = {r.gram for r in hits.groupBy("gram").count().where("count >= 24").collect()}
    of_items = {r.gram for r in found.select(F.explode("grams").alias("gram")).collect()}
    seeds = Counter(r.gram in frequent for r in decontaminate.rare_seeds(found, hits).collect())
    # 46 n-grams an item, so 5 are needed. Documents hold 6 stock ones of every item, and of the six
    # items that they copy one of each of the 10 runs of three words between edits.
    assert len(frequent & of_items) == 6
    assert seeds == {True: 12 * (6 - 5 + 1), False: 6 * 10}


def test_leaks_cover_all_long_overlaps(spark, sf, texts):
    got = {(r.doc_id, r.item_id) for r in queries()["op1_decontaminate"](spark, sf).collect()}
    want = set()
    for item in common.table(spark, sf, "benchmark").collect():
        own = decontaminate.bare_words(item.text.encode())
        grams = set(zip(own, own[1:], own[2:]))
        for i, t in texts:
            w = decontaminate.bare_words(t.encode())
            if len(grams & set(zip(w, w[1:], w[2:]))) >= 2 and decontaminate.align(own, w)[0] >= 0.6 * 2 * len(own):
                want.add((i, item.item_id))
    assert got == want


def test_long_items_and_a_large_benchmark(spark):
    """Against alignment of every document with every item, without seeds."""
    import random

    draw = random.Random(5)
    some = lambda n, of: [f"{draw.choice('abcdefgh')}{draw.randrange(of)}" for _ in range(n)]
    items = [(i, some(draw.choice((6, 20, 45, 120)), 400)) for i in range(300)] + [(900, some(3000, 400))]
    rows = []
    for i in range(60):
        words = some(draw.choice((5, 300)), 400)
        item = draw.choice(items[:300])[1] if i % 3 else items[300][1]
        keep = [w for w in item if draw.random() > 0.04]
        rows.append((i, [*words, *keep, *words[::-1]] if i % 4 else words))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    want = {(i, j) for i, w in rows for j, item in items if len(set(w) & set(item)) > len(set(item)) / 3 and decontaminate.align([x.encode() for x in item], [x.encode() for x in w])[0] >= 0.6 * 2 * len(item)}
    assert len(want) >= 40 and got == want


def test_reach_follows_the_items_of_a_hit(spark):
    item = [f"q{j}" for j in range(30)]
    docs = spark.createDataFrame([(i, " ".join([*(f"p{i}x{j}" for j in range(2000)), *item, *(f"s{i}x{j}" for j in range(2000))])) for i in range(20)], "doc_id long, text string")
    long = " ".join(f"l{j}" for j in range(4000))
    sizes = []
    for items in ([(1, " ".join(item))], [(1, " ".join(item)), (2, long)]):
        cut = decontaminate.passages_of(docs, spark.createDataFrame(items, "item_id long, text string"), 3, 0.6)[1]
        sizes.append(cut.agg(F.sum(F.length("words"))).first()[0])
    assert sizes[0] == sizes[1]


def test_alignment():
    a = "a b c d e f".split()
    assert decontaminate.align(a, a) == (12, 6)
    assert decontaminate.align(a, "x x a b c q d e f x".split()) == (11, 9)
    assert decontaminate.align(a, "a b d e f".split()) == (9, 5)
    assert decontaminate.align(a, []) == (0, 0)


# 2: classifier


def test_classifier_on_held_out_labels(spark, sf):
    import os

    large = sf if not os.path.exists("/root/testdata/sf0.01") else "/root/testdata/sf0.01"
    rows = queries()["op2_factorisation_machine"](spark, large).join(common.table(spark, large, "labels"), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)


def test_classifier_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (None, 1), (7, None), (500, 1), (9, 5)], "doc_id long, quality int")
    machine = quality_fm.fit_machine(odd, labels)
    got = by_id(quality_fm.score_quality(odd, machine), "held_out", "score")
    assert {i: h for i, (h, _) in got.items()} == {i: brute.crc(i, 5) == 0 for i, _ in ODD}
    assert all(0 <= s <= 1 for _, s in got.values())
    assert quality_fm.score_quality(none, machine).count() == 0
    assert len(quality_fm.score_quality(twice(odd), machine).collect()) == 2 * len(ODD) + 1
    empty = quality_fm.fit_machine(odd, labels.limit(0))
    assert {r.score for r in quality_fm.score_quality(odd, empty).collect()} == {0.5}


def test_machine_equals_explicit_pairs():
    import numpy as np

    m = quality_fm.Machine()
    m.w[:] = np.random.default_rng(1).normal(size=len(m.w))
    at, x = np.array([3, 99, 1000, 32800]), np.array([0.5, 1.0, 2.0, 0.25])
    pairs = sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert math.isclose(m.raw(at, x), m.w[at] @ x + pairs, rel_tol=1e-9)


def test_fit_equals_a_plain_one():
    """The fit in loops over rows, features and factors."""
    import numpy as np

    draw = np.random.default_rng(4)
    rows = []
    for _ in range(20):
        at = np.sort(draw.choice(40, 6, replace=False)).astype(np.int64)
        rows.append((at, np.where(at % 3 == 0, 1.0, 0.5)))
    labels = draw.integers(0, 2, 20).astype(float)
    m = quality_fm.Machine()
    m.fit(rows, labels, epochs=3, batch=4)
    start = quality_fm.Machine()
    w0, w, v = 0.0, {}, {int(i): start.v[i].copy() for a, _ in rows for i in a}
    g0, gw, gv = 1e-6, {}, {i: np.full(quality_fm.FACTORS, 1e-6) for i in v}
    order = np.random.default_rng(7)
    for _ in range(3):
        for own in np.array_split(order.permutation(20), 5):
            d0, dw, dv = 0.0, {}, {}
            for r in own:
                at, x = rows[r]
                raw = w0 + sum(w.get(int(i), 0.0) * a for i, a in zip(at, x))
                raw += sum(float(v[int(at[i])] @ v[int(at[j])]) * x[i] * x[j] for i in range(len(at)) for j in range(i))
                err = (1 / (1 + math.exp(-raw)) - labels[r]) / len(own)
                d0 += err
                for i, a in zip(map(int, at), x):
                    dw[i] = dw.get(i, 0.0) + err * a
                    others = sum(v[int(j)] * b for j, b in zip(at, x) if j != i)
                    dv[i] = dv.get(i, 0.0) + err * a * others
            g0 += d0 * d0
            w0 -= 0.1 * d0 / math.sqrt(g0)
            for i in dw:
                g = dw[i] + 1e-4 * w.get(i, 0.0) / 20 * len(own)
                gw[i] = gw.get(i, 1e-6) + g * g
                w[i] = w.get(i, 0.0) - 0.1 * g / math.sqrt(gw[i])
                h = dv[i] + 1e-4 * v[i]
                gv[i] = gv[i] + h * h
                v[i] = v[i] - 0.1 * h / np.sqrt(gv[i])
    assert math.isclose(m.w0, w0, rel_tol=1e-9)
    assert all(math.isclose(m.w[i], w[i], rel_tol=1e-7, abs_tol=1e-12) and np.allclose(m.v[i], v[i], rtol=1e-7) for i in w)


def test_fit_is_bounded(spark):
    rows = [(i, f"words of text {i} " * 5) for i in range(200)] + [(5, f"copy {j}") for j in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    seen = []
    fit, quality_fm.Machine.fit = quality_fm.Machine.fit, lambda self, r, y: seen.append((len(r), sum(len(a) for a, _ in r), len(y)))
    try:
        quality_fm.fit_machine(docs, labels)
        quality_fm.fit_machine(docs, labels, max_train=30)
        quality_fm.fit_machine(docs, labels, max_values=300)
    finally:
        quality_fm.Machine.fit = fit
    held = sum(brute.crc(i, 5) != 0 for i in range(200))
    assert [n for n, _, _ in seen][:2] == [held, 30] and seen[2][1] <= 300 and all(n == y for n, _, y in seen)


# 5: archives


def test_archives_equal_brute_force(spark, sf):
    pages = common.table(spark, sf, "pages")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    odd = [(1, None, None), (2, "http://a b/\n", "x" * 100), (3, "u", "x" * 100), (3, "u", "x" * 100), (4, "u", "x" * 99), (5, "u", "x" * 99), (None, "u", "y"), (6, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9), (7, "u", "é" * 50), (8, "u", "z" * 300_000), (None, "u", "x" * 100), (9, "u", "q" * 200), (9, "u", "x" * 100)]
    for given in (rows, odd):
        df = spark.createDataFrame(given, "page_id long, url string, html string").withColumn("digest", F.lit(1))
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in arc_convert.round_trip(df).collect())
        first, want = {}, Counter()
        for i, _, html in sorted(given, key=lambda r: (r[0] is None, r[0] or 0)):
            data = (html or "").encode()
            digest = hashlib.sha256(data).hexdigest()
            o = first.setdefault(digest, i) if len(data) >= 100 and i is not None else i
            want[(i, len(data), digest, "response" if o == i else "revisit", None if o == i else o)] += 1
        assert got == want
    assert arc_convert.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_files(spark, tmp_path, version):
    import gzip
    import io

    page = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n" + b"body\n\n\x00\xff" * 30
    records = [{"url": "http://x/ y", "date": "20010203040506", "content": page}, {"url": None, "date": None, "content": b""}, {"url": "dns:x", "mime": "text/dns", "date": "20020101000000", "content": b"no head"}, {"url": "http://z/", "date": "20030101000000", "content": page}]
    data = arc_convert.arc_file(records, version)
    assert data.split(b"\n")[2].startswith(b"URL IP-address Archive-date Content-type ") and data.split(b"\n")[2].endswith(b"Archive-length")
    block, *back = arc_convert.read_arc(data)
    assert block["mime"] == "filedesc" and [r["content"] for r in back] == [r["content"] for r in records] and {r["version"] for r in back} == {version}
    assert list(arc_convert.read_arc(gzip.compress(data)))[1:] == back
    assert list(arc_convert.read_arc(b"")) == []
    # A URL with a space, as real files have it, is a URL; junk is set aside, and reading goes on.
    spaced = data.replace(b"http://x/%20y", b"http://x/ y")
    assert [r["url"] for r in list(arc_convert.read_arc(spaced))[1:]] == ["http://x/ y", "-", "dns:x", "http://z/"]
    cut = data.index(b"dns:x")
    found = list(arc_convert.read_arc(data[:cut] + b"junk of no use 5x\nmore\n" + data[cut:]))
    assert [r.get("url", "!") for r in found[1:]] == ["http://x/%20y", "-", "!", "dns:x", "http://z/"] and found[3]["at"] == cut
    assert "past the end" in list(arc_convert.read_arc(data[:-9]))[-1]["error"]
    assert [r["error"][:10] for r in arc_convert.read_arc(b"junk line 5\n12345")] == ["no version"]
    folder = tmp_path / "arcs"
    folder.mkdir()
    (folder / "a.arc").write_bytes(data)
    (folder / "b.arc.gz").write_bytes(gzip.compress(data[:-9]))
    (folder / "c.arc").write_bytes(b"")
    (folder / "d.arc").write_bytes(b"no archive")
    for broadcast in (200_000, 0):
        made, quarantine = arc_convert.convert_arc_files(spark, str(folder), broadcast)
        rows = sorted(made.collect(), key=lambda r: (r["file"], r["at"]))
        parsed = list(arc_convert.read_warc(io.BytesIO(b"\r\n\r\n".join(bytes(r.record) for r in rows) + b"\r\n\r\n")))
        assert [f["warc-type"] for f, _ in parsed] == ["warcinfo", "response", "resource", "resource", "revisit", "warcinfo", "revisit", "resource", "resource"]
        fields, body = parsed[1]
        assert fields["warc-date"] == "2001-02-03T04:05:06Z" and fields["warc-target-uri"] == "http://x/%20y" and body == page
        assert fields["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"body\n\n\x00\xff" * 30).hexdigest()
        assert len({f["warc-record-id"] for f, _ in parsed}) == len(parsed) and parsed[3][0]["content-type"] == "text/dns"
        assert all(parsed[i][0]["warc-refers-to"] == fields["warc-record-id"] and parsed[i][0]["warc-refers-to-date"] == fields["warc-date"] for i in (4, 6))
        assert sorted((r.file.rsplit("/", 1)[-1], r.error[:8]) for r in quarantine.collect()) == [("b.arc.gz", "declares"), ("d.arc", "no versi")]


# 3: quotations


def test_quotations(spark):
    rows = [
        (1, 0, "u", "Hello there friend\nhow are you today?\n\nSecond paragraph here."),
        (1, 1, "a", "> how are  You today?\nFine thanks, and you?"),
        (1, 2, "u", "unrelated message entirely"),
        (1, 3, "a", "> > how are you today?\n> Fine thanks, and you?\nAlso fine."),
        (1, 4, "u", "> Second paragraph here.\nYes that one"),
        (1, 5, "u", "> never said by anyone\nWhat?"),
        (2, 0, "u", "> Also fine.\ncross quoting"),
        (2, 1, None, None),
        (None, 0, "u", "> Also fine."),
        (3, None, "u", "> Also fine.\nno turn"),
        (4, 0, "u", "same line"), (4, 0, "u", "same line"), (4, 1, "a", "same line"), (4, 2, "u", "> same line\nreply"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("own"))
    got = chat_quotes.reply_ordered(df).collect()
    assert len(got) == len(rows)
    place = {(r.conv_id, r.turn): r for r in got}
    assert [(r.turn, r.parent_turn, r.root_turn, r.depth) for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == [(0, None, 0, 0), (1, 0, 0, 1), (3, 1, 0, 2), (4, 0, 0, 1), (2, None, 2, 0), (5, None, 5, 0)]
    assert place[1, 3].body == "Also fine." and (place[1, 3].n_quotes, place[1, 3].n_linked) == (2, 2)
    assert (place[2, 0].parent_turn, place[2, 0].n_linked) == (None, 1) and place[2, 1].body == ""
    assert place[4, 2].parent_turn == 1 and place[1, 5].n_linked == 0
    assert sorted(r.position for r in got if r.conv_id == 4) == [0, 1, 2, 3]
    assert chat_quotes.reply_ordered(df.limit(0)).count() == 0


def quoting(n_convs=12, n_turns=14):
    """Conversations with nested, partial, rewrapped, short, foreign and invented quotes, and one hot line."""
    import random

    draw = random.Random(11)
    rows, bodies = [], {}
    for conv in range(n_convs):
        for turn in range(n_turns):
            lines = [f"line {draw.randrange(4000)} of {conv % 5} {draw.choice(['Über', 'says', 'x'])}" for _ in range(draw.randrange(1, 8))]
            lines.insert(draw.randrange(len(lines) + 1), draw.choice(["yes", "ok", "", "", "Thank you all."]))
            quote = []
            for _ in range(draw.randrange(3)):
                of = draw.choice(list(bodies)) if bodies and draw.random() < 0.3 else (conv, draw.randrange(turn)) if turn else None
                if of is None:
                    continue
                from_lines = bodies[of]
                a = draw.randrange(len(from_lines))
                some = from_lines[a : a + draw.randrange(1, 8)]
                if draw.random() < 0.2:
                    some = " ".join(from_lines).upper().split()
                    some = [" ".join(some[i : i + 4]) for i in range(0, len(some), 4)]
                if draw.random() < 0.1:
                    some = [*some, "never said by anyone"]
                mark = draw.choice(["> ", ">", "> > ", " >> "])
                quote += [[mark + x for x in some]]
            parts = [*quote[:1], lines[:3], *quote[1:], lines[3:]]
            rows.append((conv, turn, "u", "\n".join(x for p in parts for x in p)))
            bodies[conv, turn] = lines
    return rows


def test_quotations_equal_brute_force(spark):
    rows = quoting()
    want = brute.quotation_links([(c, t, x) for c, t, _, x in rows])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    _, linked = chat_quotes.link_quotes(df)
    got = Counter((r.conv_id, r.turn, r.depth, (r.from_conv, r.from_turn)) for r in linked.collect())
    told = Counter((*at, depth, o) for at, links in want.items() for depth, o in links if o)
    assert sum(told.values()) > 100 and any(o[0] != c for c, _, _, o in told)
    assert got == told
    by = {(r.conv_id, r.turn): r for r in chat_quotes.reply_ordered(df).collect()}
    for at, links in want.items():
        inside = [(d, o[1]) for d, o in links if o and o[0] == at[0]]
        parent = max(t for d, t in inside if d == min(inside)[0]) if inside else None
        assert (by[at].n_quotes, by[at].n_linked, by[at].parent_turn) == (len(links), sum(o is not None for _, o in links), parent)


def test_parts_of_a_message_and_short_quotes(spark):
    said = "one a\ntwo b\nthree c\nfour d\nfive e\u2028same line\n\nlast f"
    rows = [
        (1, 0, "u", said), (1, 1, "a", "> two b\n> three c\nfirst answer\n> last f\nsecond answer"), (1, 2, "u", "> one a\n> two b\n> three c\n> four d\n> five e same line\n>\n> last f\nall"),
        (1, 3, "u", "> first answer\nno"), (1, 4, "a", "> no\nwhy"), (2, 0, "u", "> no\nnot from there"), (2, 1, "u", "> three c\n> four d\n> five e same line\nfrom there"),
        (5, 0, "u", "five times"), (6, 0, "u", "five times"), (5, 1, "u", "other"), (5, -1, "u", "> five times\nsaid later here, but there too"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parsed, linked = chat_quotes.link_quotes(df)
    got = sorted((r.conv_id, r.turn, r.from_conv, r.from_turn) for r in linked.collect())
    assert got == [(1, 1, 1, 0), (1, 1, 1, 0), (1, 2, 1, 0), (1, 3, 1, 1), (1, 4, 1, 3), (2, 1, 1, 0), (5, -1, 6, 0)]
    assert [r.body for r in parsed.where("conv_id = 1 and turn = 0").collect()] == [said]
    long = "\n".join(f"row {i} of many" for i in range(3000))
    df = spark.createDataFrame([(1, 0, "u", long), (1, 1, "u", "\n".join("> " + x for x in long.split("\n")[700:2500]))], "conv_id long, turn long, role string, text string")
    assert [(r.turn, r.parent_turn) for r in chat_quotes.reply_ordered(df).orderBy("turn").collect()] == [(0, None), (1, 0)]


def test_conversations_keep_every_turn(spark, sf):
    got = queries()["op3_quotation_links"](spark, sf).collect()
    given = {(r.conv_id, r.turn): r for r in common.table(spark, sf, "conversations").collect()}
    assert {(r.conv_id, r.turn) for r in got} == set(given) and len(got) == len(given)
    order = sorted((r.conv_id, r.position, r.turn) for r in got)
    assert [(c, t) for c, _, t in order] == sorted(given)


# 10: licenses


def test_licenses(spark, odd, none):
    mit = "\n".join(["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal", "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of", "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"])
    cases = [
        (1, "Some words here.\nLicensed under the Apache License, Version 2.0.\nmore", ["Apache-2.0"]),
        (2, "Licensed under the Apache License, Version 3.0.", []),
        (3, "x. This work is licensed under the GNU General Public License, version 2. y", ["GPL-2.0"]),
        (4, "Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        (5, "Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
        (11, "Licensed under CC BY-NC-SA 2.0.", []),
        (6, f"intro\n\n{mit}\n\noutro", ["MIT"]),
        (7, "He was granted permission to redistribute the bread, with a warranty.", []),
        (8, "Released under the MIT License. " + "filler words go on " * 3000 + "Released under the MIT License.", ["MIT", "MIT"]),
        (9, None, []),
        (10, "This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string").withColumn("start", F.lit("own"))
    rows = license_scan.scan_licenses(df).collect()
    assert {c[0]: c[2] for c in cases if c[2]} == {i: [r.license for r in sorted(rows, key=lambda r: r.start) if r.doc_id == i] for i in {r.doc_id for r in rows}}
    first = next(r for r in rows if r.doc_id == 1)
    assert cases[0][1][first.start : first.end].startswith("Licensed under") and first.exact and first.reduction > 0
    assert license_scan.scan_licenses(none).count() == 0 and license_scan.scan_licenses(odd).count() == 0


def test_ordinary_notices(spark):
    notices = {
        "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "/* SPDX-License-Identifier: GPL-2.0-only */": "GPL-2.0",
        "Released under the ISC License.": "ISC", "This file is licensed under the Mozilla Public License 2.0.": "MPL-2.0",
        "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0", "Licensed under the EUPL, Version 1.2": "EUPL-1.2", "Released under the MIT Licence.": "MIT",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "LGPL-2.1",
    }
    rows = [(i, f"Some text before.\n\n{x}\n\nAnd after.") for i, x in enumerate(notices)]
    rows.append((50, f"All in one line: {next(reversed(notices))} Also {license_scan.TEMPLATES['MIT'][2]} Fine."))
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id", "start").collect()
    assert [(r.doc_id, r.license) for r in found] == [*enumerate(notices.values()), (50, "LGPL-2.1"), (50, "MIT")]
    assert len(license_scan.TEMPLATES) >= 40
    for texts in license_scan.TEMPLATES.values():
        assert all(any(c in t.lower() for c in license_scan.CUES) for t in texts)


def test_whole_texts_are_one_finding(spark):
    bsd = next(t for t in license_scan.TEMPLATES["BSD-3-Clause"] if len(t) > 800)
    at = [bsd.index(x) for x in ("Redistributions of", "Redistributions in", "Neither", "THIS SOFTWARE")]
    parts = [bsd[: at[0]], "1. " + bsd[at[0] : at[1]], "2. " + bsd[at[1] : at[2]], "3. " + bsd[at[2] : at[3]], bsd[at[3] :]]
    mit = license_scan.TEMPLATES["MIT"][4]
    cuts = [mit.index("The above copyright"), mit.index("THE SOFTWARE IS")]
    texts = ["BSD 3-Clause License\n\nCopyright (c) 2020, Someone\n\n" + "\n\n".join(parts), "MIT License\n\nCopyright (c) 1999 Me\n\n" + "\n\n".join((mit[: cuts[0]], mit[cuts[0] : cuts[1]], mit[cuts[1] :]))]
    filler = "word " * 4000
    df = spark.createDataFrame([(i, f"{filler}\n\n{t}\n\n{filler}") for i, t in enumerate(texts)], "doc_id long, text string")
    found = license_scan.scan_licenses(df).orderBy("doc_id").collect()
    assert [(r.doc_id, r.license, r.exact) for r in found] == [(0, "BSD-3-Clause", True), (1, "MIT", True)]
    assert all(r.end - r.start > 800 for r in found)


def test_license_findings_equal_brute_force(texts):
    """Every template on every block, without the choice by rare words; spans and differences from the words."""
    import difflib
    import random

    t = license_scan.Templates()
    draw = random.Random(3)
    some = [x for texts in license_scan.TEMPLATES.values() for x in draw.sample(texts, min(2, len(texts)))]
    given = [x for _, x in texts if "icense" in x][:10]
    for x in draw.sample(some, 40):
        words = x.split()
        words[draw.randrange(len(words))] = "changed"
        given += [x, " ".join(["before.", *words, "after."]), f"{x}\n{draw.choice(some)}"]
    for text in given:
        for a, b in license_scan.blocks(text):
            block = text[a:b]
            have = license_scan.normal_words(block)
            want = []
            for saved, reduction, i in t.ranked(block):
                words = t.all[i][2]
                pairs = [(m.a + k, m.b + k) for m in difflib.SequenceMatcher(None, words, [w for w, _, _ in have], autojunk=False).get_matching_blocks() for k in range(m.size)]
                if saved <= 0 or len(pairs) < 0.9 * len(words) or pairs[-1][1] + 1 - pairs[0][1] > 1.3 * len(words) + 2:
                    continue
                missing = [w for k, w in enumerate(words) if k not in {p for p, _ in pairs}]
                extra = [have[k][0] for k in range(pairs[0][1], pairs[-1][1]) if k not in {q for _, q in pairs}]
                if any(w in license_scan._DECISIVE or any(c.isdigit() for c in w) for w in missing + extra):
                    continue
                low, high = have[pairs[0][1]][1], have[pairs[-1][1]][2]
                if all(high <= x[3] or low >= x[4] for x in want):
                    want.append((t.all[i][0], saved, reduction, low, high, " ".join(missing), " ".join(extra)))
            assert t.match(block) == want


def test_license_lines_of_the_corpus(spark, sf, texts):
    got = {r.doc_id for r in queries()["op10_license_scan"](spark, sf).collect()}
    assert got == {i for i, t in texts if any(x in t for x in ("Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."))}


def test_sketches_never_refuse_a_link():
    import numpy as np

    draw = np.random.default_rng(3)
    for n in (300, 2100, 4095, 4097, 9000):
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.concatenate([a[n // 30 :], draw.integers(0, 1 << 63, n // 90, dtype=np.uint64)])
        size = lambda x: 1 << (len(x) - 1).bit_length()
        apart = jaccard_join.far_apart(jaccard_join.parity_bits(a, size(a)), jaccard_join.parity_bits(b, size(b)))
        assert 0 < apart <= len(np.setxor1d(a, b))


def test_long_near_copies(spark):
    words = [f"w{i * i % 7919}x{i}" for i in range(5000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:4900])), (3, " ".join(words[:4000])), (4, " ".join(f"v{i}" for i in range(5000))), (5, " ".join(words[300:]))]
    got = by_id(jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), bits=8), "n_shingles", "component_id", "n_links")
    assert got == brute.jaccard_groups(rows)


@pytest.mark.parametrize("name", ["op4_jaccard_join", "op5_archive_converter", "op7_mix_sources"])
def test_queries_equal_their_sql(spark, sf, name):
    from kinloom.llm.queries import oracle_sql
    from oracle import same

    same(spark, sf, queries()[name], oracle_sql()[name])
