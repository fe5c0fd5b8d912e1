"""Every operator on edge rows and empty tables, against brute force."""

import os
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import (components, decontaminate, language_id, line_dedup, mixing, near_dedup, quality_rules, secret_scan, substring_dedup,
                           token_counts, tokenizer, training_order)
from sparkmart.session import scratch_path
from tests.llm import brute


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("limit", [substring_dedup.GROUP_LIMIT, 1])
def test_substring_dedup_matches_brute_force(edge, edge_rows, limit):
    """limit 1 sends every mixed prefix down the long-prefix way."""
    got = rows_of(substring_dedup.remove_repeats(edge, group_limit=limit), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.repeats([(r[0], r[1]) for r in edge_rows]), key=repr)


def test_substring_dedup_keeps_text(edge):
    df = substring_dedup.remove_repeats(edge, with_text=True).where("doc_id = 3").first()
    assert df["n_removed"] == 60 and len(df["kept"].split()) == 50


def test_secret_scan_matches_brute_force(spark, edge, edge_rows):
    got = rows_of(secret_scan.report(edge, scratch_path(spark, "ledger")), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for r in edge_rows:
        found = brute.secrets(r[1])
        kinds = Counter(k for k, _, _ in found)
        want.append((r[0], kinds["assign"], kinds["access"], kinds["hex"], brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))))
    assert got == sorted(want, key=repr)


def test_secret_ledger_is_incremental(spark, edge):
    ledger = scratch_path(spark, "ledger")
    first = rows_of(secret_scan.report(edge, ledger, "doc_id"), "doc_id", "spans")
    size = secret_scan.read_ledger(spark, ledger).count()
    assert rows_of(secret_scan.report(edge, ledger, "doc_id"), "doc_id", "spans") == first
    assert secret_scan.read_ledger(spark, ledger).count() == size  # nothing was scanned again
    new = spark.createDataFrame([(7000, "secret=abcdefgh")], "doc_id long, text string")
    secret_scan.scan(new, ledger)
    assert secret_scan.read_ledger(spark, ledger).count() == size + 1
    rules = secret_scan.BASE + (secret_scan.Rule("pem", "BEGIN", version=2),)
    secret_scan.scan(new, ledger, rules=rules)
    assert secret_scan.read_ledger(spark, ledger).where("array_contains(rules, 'pem@2')").first()["rules"] == ["pem@2"]


def test_line_dedup(spark, edge, edge_rows):
    got = {(r["doc_id"], r["kept"]) for r in line_dedup.deduplicate(edge).collect() if r["doc_id"] in (12, 16, 17)}
    assert (16, "l1 a\nl2 b\nl3 c\nl4 d\nx") in got and (17, "y") in got
    assert (12, "same line here\n") in got  # runs may overlap: the first one starts at line 0
    assert line_dedup.deduplicate(edge).count() == len(edge_rows)


def test_mixing(edge, edge_rows):
    df = mixing.report(edge).toPandas()
    size = {s: sum(len(brute.words(r[1])) for r in edge_rows if r[3] == s) for s in ("s1", "s2", "s3", None)}
    total, weight, target = sum(size.values()), {"s1": 5, "s2": 2, "s3": 1, None: 5}, {}
    left, open_ = 1.5 * total, dict(weight)
    while open_:
        level = left / sum(open_.values())
        cut = [s for s in open_ if level * open_[s] > 2 * size[s]]
        if not cut:
            target |= {s: level * w for s, w in open_.items()}
            break
        for s in cut:
            target[s], left = 2 * size[s], left - 2 * size[s]
            open_.pop(s)
    for s, t in target.items():
        part = df[df.source_size == size[s]]
        assert np.allclose(part.target, t) and abs(part.taken.sum() - t) <= 1
    assert (df.taken <= 2 * df["size"]).all() and len(df) == len(edge_rows)
    again = mixing.report(edge.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(repr, df[key].values.tolist())) == sorted(map(repr, again[key].values.tolist()))


def test_mix_orders_whole_documents(edge):
    df = mixing.mix(edge)
    assert df.columns == edge.columns
    assert {r["text"] for r in df.collect()} <= {r["text"] for r in edge.collect()}


def test_quality_base_counts(edge, edge_rows):
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = rows_of(quality_rules.report(edge), "doc_id", *cols)
    assert got == sorted(((r[0], *brute.quality(r[1])) for r in edge_rows), key=repr)
    assert quality_rules.keep_good(edge).columns == edge.columns


def test_quality_distance_matches_formula(spark):
    refs = [{"lang": "x", "classes": [0.1, 0, 0.1, 0, 0, 0.2, 0.6], "words": {"the": 0.2, "of": 0.1}}]
    text = "the of the zebra. THE quick" + " jumps over" * 200
    row = quality_rules.judge(spark.createDataFrame([(text,)], "text string"), refs).first()[-1]
    w = text.split()
    p = {"the": sum(x.strip(".").lower() == "the" for x in w) / len(w), "of": w.count("of") / len(w)}
    p["rest"], q = 1 - sum(p.values()), {"the": 0.2, "of": 0.1, "rest": 0.7}
    js = sum(0.5 * a * np.log2(2 * a / (a + b)) + 0.5 * b * np.log2(2 * b / (a + b)) for a, b in ((p[k], q[k]) for k in q))
    assert row["word_distance"] == pytest.approx(np.sqrt(js))


def test_near_dedup_matches_brute_force(edge, edge_rows):
    got = near_dedup.classes(edge.where("doc_id is not null")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, groups.values())) == brute.near_classes([(r[0], r[1]) for r in edge_rows if r[0] is not None])
    kept = near_dedup.deduplicate(edge)
    assert kept.columns == edge.columns
    assert kept.where("doc_id in (0, 1, 2)").count() == 1


def test_near_dedup_block_links():
    rng = np.random.default_rng(1)
    base = rng.integers(1, 1 << 60, 200).astype(np.uint64)
    items = []
    for i in range(30):
        keep = np.unique(np.concatenate((base[: 200 - 4 * (i % 10)], rng.integers(1, 1 << 60, 4 * (i % 10)).astype(np.uint64))))
        items.append((i, i, keep, np.ones(len(keep))))
    links = near_dedup.block_links(items, items, 0.8)
    want = {frozenset((a, b)) for a in range(30) for b in range(a) if len(np.intersect1d(items[a][2], items[b][2])) >= 0.8 * len(np.union1d(items[a][2], items[b][2]))}

    def groups(pairs):
        root = list(range(30))
        for _ in range(30):
            for a, b in map(tuple, pairs):
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups([frozenset(x) for x in links]) == groups(want) and {frozenset(x) for x in links} <= want


def test_icws_collision_rate_estimates_weighted_jaccard():
    rng = np.random.default_rng(5)
    u = np.unique(rng.integers(1, 1 << 62, 300).astype(np.uint64))
    w = rng.random(len(u)) + 0.2
    v, x = u[60:], w[60:] * 1.3
    exact = np.minimum(w[60:], x).sum() / (w.sum() + x.sum() - np.minimum(w[60:], x).sum())
    rate = (near_dedup.icws(u, w, 4096) == near_dedup.icws(v, x, 4096)).mean()
    assert abs(rate - exact) < 0.05


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["comp"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}


def test_language_id(spark):
    syllables = {"aa": ["ba", "be", "bi"], "bb": ["zor", "zum", "zax"]}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("".join(rng.choice(syllables[k], 3)) for _ in range(30)), k) for i in range(200) for k in [("aa", "bb")[i % 2]]]
    rows += [(1000, None, "aa"), (1001, "12 34 !!", "bb"), (None, "babebi", None), (1002, "Zor", None)]
    df = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).toPandas()
    truth = {r[0]: r[2] for r in rows}
    held = df[df.held_out & (df.doc_id < 1000)]
    assert len(held) > 20 and all(truth[i] == p for i, p in zip(held.doc_id, held.lang_pred))
    assert set(df[df.doc_id.isin([1000, 1001])].lang_pred) == {"und"}
    assert df.score.between(0, 1).all() and len(df) == len(rows)


def test_every_letter_has_its_own_vector():
    points = np.array([c for c in range(1, 0x3000) if chr(c).isalpha()])
    assert len(np.unique(language_id.letter_vectors(points), axis=0)) == len(points)
    near, far = language_id.trigrams("łâ é"), language_id.trigrams("łâ é漢")
    assert (language_id.gram_vectors(near)[:3] == language_id.gram_vectors(far)[:3]).all()  # table and drawn vectors agree
    assert language_id.gram_vectors(language_id.trigrams("漢")).shape == (1, language_id.DIM)


def test_decontamination(spark):
    item = "Anna has 12 apples and gives 5 km of rope to Bernd before the 12 horses arrive home safely."
    other = item.replace("12", "31").replace("5 km", "9 miles").replace("Bernd", "Clara")
    broken = item.replace("12 apples", "31 apples").replace("the 12", "the 44")
    docs = [(1, "x y z. " + item + " tail"), (2, "Start here. " + other), (3, "Start. " + broken), (4, "nothing of it at all " * 10),
            (5, None), (6, ""), (1, "x y z. " + item + " tail"), (7, "short words of five here"), (None, item)]
    bench = spark.createDataFrame([(10, item), (11, "words of five here now"), (12, "too short"), (13, None)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h1", F.lit("clash"))
    got = {r["doc_id"]: r for r in decontaminate.report(df, bench).collect()}
    assert got[1]["items"] == [10] and not got[1]["reparameterised"]
    assert got[2]["items"] == [10] and got[2]["reparameterised"]
    assert got[None]["items"] == [10]
    assert not any(got[k]["contaminated"] for k in (3, 4, 5, 6, 7))
    assert sorted(r["doc_id"] for r in decontaminate.remove_leaks(df, bench).collect()) == [3, 4, 5, 6, 7]


def test_decontamination_of_edited_short_and_numeric_items(spark):
    opening = "Tom has 5 apples in a bag. Tom gives 3 of them to a friend and eats the rest before noon."
    sixteen = "seven quiet rivers run below old stone bridges where tired birds gather every single cold autumn morning"
    numbers = " ".join(str(n) for n in range(12, 45, 3))
    items = [(1, opening), (2, sixteen), (3, "a b c d"), (4, numbers), (5, ""), (6, "ok")]
    docs = [(1, opening.replace("Tom", "Ben").replace("5", "8")), (2, opening.replace("Tom gives", "Ann gives")),
            *[(10 + k, " ".join("other" if i == k else w for i, w in enumerate(sixteen.split()))) for k in range(16)],
            (30, "a b c d"), (31, "text\n A b, c d!\nmore"), (32, "here a b c d is inside a line"), (33, numbers),
            (34, " ".join(str(n + 1) for n in range(12, 45, 3))), (35, "nothing to see here at all today"), (36, "all of it is ok")]
    rows = [(i, t) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.report(df, bench).collect()}
    assert got == brute.leaked_items(rows, items, decontaminate.UNITS)
    assert got[1] == {1} and all(got[10 + k] == {2} for k in range(16))
    assert got[30] == got[31] == {3} and got[33] == {4}
    assert not any(got[k] for k in (32, 34, 35, 36))


def test_token_counts_match_tokenizer(spark, edge, edge_rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    got = {}
    for r in token_counts.attribute(edge.where("doc_id is not null").dropDuplicates(["doc_id"])).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = (r["start"], r["stop"], r["n_tokens"], r["doc_tokens"])
    for i, text in {r[0]: r[1] for r in edge_rows if r[0] is not None}.items():
        text = text or ""
        spans = whole.encode(text, add_special_tokens=False).offsets
        ids = tokenizer.Encoder(tokenizer.load_vocabulary()).ids(text).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids
        parts = list(got[i].values())
        assert "".join(text[a:b] for a, b, _, _ in parts) == text
        assert sum(n for _, _, n, _ in parts) == len(spans) == parts[0][3]


def test_token_rules_share_and_middle(spark):
    df = spark.createDataFrame([(1, "hello world wide")], "doc_id long, text string")
    cut = F.array(F.struct(F.lit(0).alias("start"), F.lit(7).alias("stop")), F.struct(F.lit(7).alias("start"), F.lit(99).alias("stop")))
    counts = {r: [x["n_tokens"] for x in token_counts.attribute(df, sections=cut, rule=r).orderBy("section").collect()] for r in token_counts.RULES}
    assert counts["start"] == [2.0, 1.0] and counts["middle"] == [1.0, 2.0]
    assert counts["share"] == pytest.approx([1 + 2 / 6, 1 + 4 / 6])


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(training_order.feistel(np.arange(n), n)) == list(range(n))
    if n > 100:
        assert not (training_order.feistel(np.arange(n), n, key=1) == training_order.feistel(np.arange(n), n, key=2)).all()


def test_training_order_round_trip(spark, edge, edge_rows, local_tmp):
    rows = training_order.sequences(edge, length=64, per_shard=7)
    got = rows.collect()
    assert [r["slot"] for r in got] == list(range(len(got)))
    enc = tokenizer.Encoder(tokenizer.load_vocabulary())
    stream = np.concatenate([np.frombuffer(bytes(r["tokens"]), "<u2")[: r["n_tokens"]] for r in sorted(got, key=lambda r: r["seq"])])
    docs = np.split(stream, np.flatnonzero(stream == enc.eos) + 1)[:-1]
    want = Counter(enc.ids(r[1] or "").tobytes() for r in edge_rows)
    assert Counter(d[:-1].tobytes() for d in docs) == want
    folder = "file://" + local_tmp
    training_order.write_shards(rows, folder).collect()
    back = list(training_order.read_slots(folder, 5, len(got), 64, 7))
    assert all((a == np.frombuffer(bytes(b["tokens"]), "<u2")).all() for a, b in zip(back, got[5:])) and len(back) == len(got) - 5


def test_materialise_reads_back_its_shards(edge, local_tmp):
    want = {r["seq"]: r for r in training_order.sequences(edge, length=64, per_shard=7).collect()}
    for folder in (local_tmp + "/a", None, local_tmp + "/a"):  # the last replaces the shards of the first
        got = training_order.materialise(edge, folder, length=64, per_shard=7).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want.values()))
    files = sorted(f for f in os.listdir(local_tmp + "/a"))
    assert files == [f"shard-{k:08d}.bin" for k in range(-(-len(want) // 7))]
    assert all(os.path.getsize(f"{local_tmp}/a/{f}") == 7 * 128 for f in files[:-1])
    rows = training_order.materialise(edge, local_tmp + "/a", length=64, per_shard=7)
    with open(f"{local_tmp}/a/{files[0]}", "r+b") as f:  # what is returned is what the files hold
        f.write(b"\xff" * 128)
    assert [r["slot"] for r in rows.collect() if bytes(r["tokens"]) == b"\xff" * 128] == [0]


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert token_counts.attribute(empty).count() == 0
    assert secret_scan.report(empty, scratch_path(spark, "ledger")).count() == 0
    assert line_dedup.report(empty).count() == 0
    assert mixing.report(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert language_id.identify(empty).count() == 0
    assert decontaminate.report(empty, bench).count() == 0 and decontaminate.remove_leaks(empty, bench).count() == 0
    assert quality_rules.report(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0
    assert near_dedup.classes(empty).count() == 0 and near_dedup.deduplicate(empty).count() == 0
    assert training_order.sequences(empty).count() == 0 and training_order.materialise(empty).count() == 0


def test_near_dedup_counts_every_shingle_on_its_own(spark):
    """A pair at 0.798 under exact document frequencies, amid 900,000 shingles that share cells of any fixed table."""
    rng = np.random.default_rng(7)
    fresh = lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 1 << 60, n))
    shared = fresh(807)
    rows = [(0, shared + " " + fresh(98)), (1, shared + " " + fresh(99))] + [(i, fresh(1500)) for i in range(2, 602)]
    want = brute.near_classes(rows[:2] + [(i, "") for i in range(2, 602)])  # the other texts only add to n
    assert [0] in want and [1] in want
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("doc_id < 2").collect()
    assert sorted(r["class_id"] for r in got) == [0, 1]


def test_line_dedup_of_single_lines(spark):
    rows = [(1, "a b\nlicense text\nc"), (2, "x\n license text\ny"), (3, "license text")]
    got = {r["doc_id"]: r["kept"] for r in line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), run=1).collect()}
    assert got == {1: "a b\nlicense text\nc", 2: "x\ny", 3: ""}


def test_quality_references_of_every_language(spark, monkeypatch):
    """Blocks of a few languages give what one block of all gives, and no language goes without a reference."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(12):
        own = ["".join(chr(97 + (2 * k + int(x)) % 26) for x in rng.integers(0, 6, 4)) for _ in range(15)]
        rows += [(10 * k + j, " ".join(own[i] for i in rng.integers(0, 15, 120)), f"l{k:02d}") for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {r["doc_id"]: r for r in quality_rules.report(df).collect()}
    monkeypatch.setattr(quality_rules, "BLOCK_LANGUAGES", 2)
    cut = {r["doc_id"]: r for r in quality_rules.report(df).collect()}
    assert all(cut[i]["word_distance"] == pytest.approx(whole[i]["word_distance"]) and cut[i]["kept"] == r["kept"] for i, r in whole.items())
    assert all(r["word_distance"] < 0.3 for r in cut.values())
    assert quality_rules.keep_good(df).count() == sum(r["kept"] for r in whole.values())


def test_quality_of_three_hundred_languages(spark):
    """At the default block size; long words and any number of trailing stops count on both sides."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(300):
        own = [f"w{k}" + "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 7)) for _ in range(10)]
        rows += [(2 * k + j, " ".join(own[i].capitalize() + "..." for i in rng.integers(0, 10, 80)), f"l{k:03d}") for j in range(2)]
    rows.append((1000, " ".join(f"alien{i}" for i in range(80)), None))
    rows += [(1001, ("é" * 100_000 + "! ") * 60, "long"), (1002, ("É" * 100_000 + " ") * 60, None)]
    start = time.time()
    got = {r["doc_id"]: r for r in quality_rules.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert time.time() - start < 90
    assert all(got[i]["word_distance"] < 0.3 for i in range(600))
    assert got[1001]["word_distance"] == got[1002]["word_distance"] == pytest.approx(0.0, abs=1e-6)
    assert got[1000]["word_distance"] == pytest.approx(1.0) and not got[1000]["kept"]


def test_remove_leaks_with_clashing_columns(spark, edge):
    """Columns of any name pass through, also those that the operator works with."""
    text = "how many red apples does the old farmer sell at the market every single morning in june"
    docs = spark.createDataFrame([(1, text, "x", "y", "z"), (2, "nothing of the kind", "x", "y", "z"), (3, None, None, None, None)],
                                 "doc_id long, text string, b1 string, b2 string, H1 string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    kept = decontaminate.remove_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == [(2, "nothing of the kind", "x", "y", "z"), (3, None, None, None, None)]


@pytest.mark.parametrize("run", [1, 2, 3])
def test_line_dedup_matches_brute_force(spark, run):
    rng = np.random.default_rng(run)
    pick = lambda: ["", "  ", "a", " a", "b b", "c\t", "d", "\u00e9"][rng.integers(8)]
    rows = [(i, "\n".join(pick() for _ in range(rng.integers(0, 12)))) for i in range(80)] + [(80, None), (81, "")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, r1 string").repartition(4)
    got = {r["doc_id"]: r["kept"] for r in line_dedup.deduplicate(df, run=run).collect()}
    assert got == brute.line_dedup(rows, run)


def test_line_dedup_of_a_very_long_text(spark):
    """Time grows with the lines: 100,000 equal lines among different ones in one text."""
    rows = [(1, "\n".join("same line" if i % 2 else f"line {i}" for i in range(200_000)))]
    begin = time.time()
    row = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert row["n_removed"] == 99_999 and row["kept"].count("\n") == 100_000
    assert time.time() - begin < 20
