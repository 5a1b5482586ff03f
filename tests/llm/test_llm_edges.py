"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names, hot groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from vacancia.llm import chat, components, lines, mixing, pii, quality, scoring, secrets, simhash, urls, winnow

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHES = ("key", "row", "size", "u", "h", "k", "fp", "hits", "base", "spans", "marks", "left", "plan", "in_0", "copies")


def prose(n, seed, stem="w"):
    r = random.Random(seed)
    return " ".join(f"{stem}{r.randrange(5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    long = prose(40_000, 1)
    rows = [
        (1, prose(80, 2), "en", "a", 1), (2, prose(80, 2), "en", "a", 1), (3, None, "en", "a", 1), (4, "", None, None, None),
        (5, long, "en", "b", 1), (None, prose(60, 3), "en", None, 1), (7, " \n\t ", "en", "b", 1),
        (8, prose(70, 4), "en", "c", 1), (8, prose(70, 4), "en", "c", 1), (9, "é" * 300, "fr", "c", 1), (10, "\ue000\ue001 x", "en", "c", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


def crowded(df):
    """The frame with further columns named like the operators' own."""
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES) if c not in df.columns])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, prose(12, 50)), (2, "tiny item"), (3, None), (4, ""), (1, prose(12, 50)), (None, "solo")]
    return spark.createDataFrame(rows, "item_id long, text string")


LABELS = "doc_id long"
REPORTS = {
    "mixing": lambda d, s: mixing.mix_sizes(d, (5, 2, 1)),
    "simhash": lambda d, s: simhash.near_duplicates(d),
    "scoring": lambda d, s: scoring.score_against(d, s.createDataFrame([(1,), (1,), (None,)], LABELS)),
    "pii": lambda d, s: pii.personal_data(d),
    "secrets": lambda d, s: secrets.secrets(d),
    "quality": lambda d, s: quality.judge(d, features=quality.FEATURES),
    "lines": lambda d, s: lines.line_report(d, least_pages=1, ratio=0.9),
    "winnow": lambda d, s: winnow.contamination(d, s.createDataFrame([(1, "tiny item")], "item_id long, text string")),
}
FILTERS = {
    "mixing": lambda d, s: mixing.mix(d, (5, 2, 1)),
    "simhash": lambda d, s: simhash.drop_near_duplicates(d),
    "quality": lambda d, s: quality.keep_good(d),
    "lines": lambda d, s: lines.drop_boilerplate(d, least_pages=1, ratio=0.9),
    "winnow": lambda d, s: winnow.drop_contaminated(d, s.createDataFrame([(1, "tiny item")], "item_id long, text string")),
}


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", REPORTS)
def test_report_has_every_row_whatever_else_is_there(spark, docs, empty, name):
    report = REPORTS[name](docs, spark)
    assert report.count() == 11
    assert rows(report) == rows(REPORTS[name](crowded(docs), spark))
    assert REPORTS[name](empty, spark).count() == 0


@pytest.mark.parametrize("name", FILTERS)
def test_filter_gives_the_columns_it_got(spark, docs, empty, name):
    more = crowded(docs)
    found = FILTERS[name](more, spark)
    assert found.columns == more.columns
    assert rows(found.select(*docs.columns)) == rows(FILTERS[name](docs, spark))
    assert FILTERS[name](empty, spark).count() == 0


def test_mix_repeats_rows_and_meets_targets(spark):
    r = random.Random(7)
    made = [(i, " ".join(["w"] * r.randrange(1, 60)), "en", s, 1) for i, s in enumerate("a" * 600 + "b" * 200 + "c" * 200)]
    made += [(5000 + i, "x y", "en", None, 1) for i in range(20)]
    df = spark.createDataFrame(made, DOCS)
    found = mixing.mix_sizes(df, (5, 2, 1)).collect()
    by = {}
    for x in found:
        s = by.setdefault(x.source, [0, 0, x.target, x.source_size])
        s[0] += x.taken
        s[1] += x.size
        assert 0 <= x.taken <= 2 * x.size
    total = sum(s[1] for s in by.values())
    assert sum(s[2] for s in by.values()) == pytest.approx(1.5 * total)
    for taken, size, target, known in by.values():
        assert size == known and target <= 2 * size
        assert abs(taken - target) <= max(3, 0.002 * target)
    mixed = mixing.mix(df, (5, 2, 1))
    assert mixed.count() == sum(x.copies for x in found)
    assert rows(mixed) == rows(mixing.mix(df.repartition(5), (5, 2, 1)))


def test_mix_draws_each_document_with_its_chance(spark):
    """Over many seeds a document of a source with chance 1/2 is taken about every other time."""
    df = spark.createDataFrame([(i, "one two three", "en", s, 1) for i, s in enumerate("a" * 40 + "b" * 40)], DOCS)
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    taken = np.zeros(80)
    for seed in range(6):
        for x in mixing.mix_sizes(df, weights, share=0.5, seed=seed).collect():
            taken[x.doc_id] += x.copies
    assert taken.sum() == 6 * 40
    assert taken[:40].std() > 0.8 and (taken == 6).sum() <= 8 and (taken == 0).sum() <= 8


def test_mix_follows_worth(spark):
    """Chances are unequal within a source: documents of twice the worth come about twice as often."""
    made = [(i, "one two three four", "en", "a", 1 + i % 2) for i in range(300)] + [(900, "x", "en", "a", None), (901, "x", "en", "a", 500)]
    df = spark.createDataFrame(made, DOCS)
    taken = np.zeros(1000)
    for seed in range(4):
        found = mixing.mix_sizes(df, (1,), share=0.5, seed=seed, worth="n_chars").collect()
        assert abs(sum(x.taken for x in found) - 0.5 * 1202) <= 4
        for x in found:
            taken[x.doc_id] += x.copies
    light, heavy = taken[:300:2].mean() / 4, taken[1:300:2].mean() / 4
    assert light == pytest.approx(1 / 3, abs=0.07) and heavy == pytest.approx(2 / 3, abs=0.07)
    assert taken[900] == 0 and taken[901] == 8  # no worth, none; at most two copies
    whole = mixing.mix_sizes(df, (1,), share=0.5, worth="n_chars").agg(F.sum("copies")).first()[0]
    assert mixing.mix(df, (1,), share=0.5, worth="n_chars").count() == whole


def test_targets_stop_at_twice_the_source(spark):
    totals = spark.createDataFrame([("a", 1, 10), ("b", 1, 100), ("c", 1, 1000), (None, 1, 0)], "source string, n long, source_size long")
    weights = mixing.cyclic_weights(totals.select("source"), (5, 2, 1))
    got = {r.source: r.target for r in mixing.source_targets(totals, weights, 1.5, 2.0).collect()}
    assert got == {"a": 20.0, "b": 200.0, "c": pytest.approx(1.5 * 1110 - 220), None: 0.0}


def test_rows_of_one_key_and_text_leave_the_same_one(spark):
    made = [(1, "the same words of a text", "en", f"s{i}", i) for i in range(9)] + [(2, "something else altogether here", "en", None, 1)]
    df = spark.createDataFrame(made, DOCS)
    kept = {tuple(rows(simhash.drop_near_duplicates(df.repartition(n, "source")))) for n in (1, 3, 7)}
    assert len(kept) == 1 and len(kept.pop()) == 2


def test_near_copies_are_one_and_repeats_go(spark, docs):
    left = simhash.drop_near_duplicates(docs).collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in left)
    # 2 copies 1, 8 is there twice, and 3, 4 and 7 have no words.
    assert ids == [(False, 1), (False, 3), (False, 5), (False, 8), (False, 9), (False, 10), (True, 0)]
    prints = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert prints[3] == prints[4] == prints[7] == "0" * 16


def test_hot_bucket_is_cut_without_losing_links(spark):
    """Fingerprints around one centre, in work units of 16, against all pairs."""
    r = random.Random(3)
    centre = r.getrandbits(64)
    prints = sorted({centre ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 9))) for _ in range(400)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "key long, fp long")
    links = simhash.near_links(df, simhash.Pivots(), tile=16)
    got = {x.node: x.root for x in components.components(links).collect()}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i + 1, len(prints)):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(j)] = find(i)
    same = {}
    for i, p in enumerate(signed):
        same.setdefault(find(i), set()).add(p)
    assert {p: min(g) for g in same.values() for p in g if p != min(g)} == got


def test_components_of_a_long_path_and_a_wide_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(300)]
    odd = [(5000, 5000), (None, 1), (5, None), (7, 6)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(path + star + odd, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001 + i: 1000 for i in range(300)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pivot_buckets_meet_for_all_near_pairs():
    r = np.random.default_rng(1)
    x = r.integers(0, 2**64, 3000, dtype=np.uint64)
    flips = np.array([[1 << a, 1 << b] for a, b in r.integers(0, 64, (3000, 2)).tolist()], dtype=np.uint64)
    y = x ^ flips[:, 0] ^ flips[:, 1]
    p = simhash.Pivots()
    assert (p.buckets(x) == p.buckets(y)).any(axis=1).all()
    i, j = (np.concatenate(z) for z in zip(*p.near(x, y, False)))
    assert set(range(3000)) <= {a for a, b in zip(i.tolist(), j.tolist()) if a == b}


def test_score_of_texts_without_tokens_is_null(spark, docs):
    got = {r.doc_id: r for r in REPORTS["scoring"](docs, spark).collect()}
    assert got[3].difference is None and got[4].n_tokens == 0 and got[7].n_tokens == 4
    assert got[1].difference == got[2].difference


def test_rare_bytes_are_told_apart(spark):
    """Digits and other scripts, in a corpus whose commonest bytes are Latin letters and symbols."""
    common = "abcdefghijklmnopqrstuvwxyz .,;:!?()-+*/=<>" * 20
    pairs = [("111 111 222 ", "777 777 888 "), ("снег снег ", "хлеб хлеб "), ("漢字漢字", "日本日本")]
    made = [(i, common) for i in range(50)]
    for i, (ours, others) in enumerate(pairs):
        made += [(100 + i, ours * 9), (200 + i, others * 9), (300 + i, ours * 5), (400 + i, others * 5)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(100 + i,) for i in range(len(pairs))], LABELS)
    got = {r.doc_id: r.difference for r in scoring.score_against(df, labels).collect()}
    assert all(got[300 + i] < got[400 + i] for i in range(len(pairs)))


def test_pii_bootstraps_from_seeds(spark):
    r = random.Random(2)
    made = [(i, f"{prose(20, i)} please contact agent {r.randrange(100)}.{i}@mail.org now {prose(9, i + 99)}") for i in range(6)]
    made += [(10, f"{prose(20, 10)} please contact agent AB-{4711:06d} now {prose(9, 5)}"),  # unseen form, learned context
             (11, f"{prose(20, 11)} the parcel weighs 47110815 grams"),
             (12, "a@b.cc_d@e.fg +1 (286) 555-5136 1.2.3.4 256.1.1.1 4111 1111 1111 1111 4111111111111112 é 9.9.9.9"), (13, None)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = {x.doc_id: x for x in pii.personal_data(df).collect()}
    for i, text in made:
        base = [(s.kind, s.start, s.end) for s in got[i].base]
        assert base == brute.pii_spans(text)
        new = [text[s.start:s.end] for s in got[i].spans if s.kind == "id"]
        assert new == (["AB-004711"] if i == 10 else [])


def test_pii_patterns_are_followed_to_the_end(spark):
    """Each pattern needs what the one before has found; 0.75 is met by 60 seeds and 10 found ones of 80."""
    edges = []
    for k in range(7):
        known = [(f"p{k}", k, i, 1) for i in range(60)]
        given = [(f"p{k}", 100 + k - 1, i, 1 if k == 0 else 0) for i in range(10)]
        edges += known + given + [(f"p{k}", 100 + k, i, 0) for i in range(10)]
    edges += [("loose", 500, i, int(i < 60)) for i in range(90)]
    found = pii.learn(spark.createDataFrame(edges, "pattern string, h long, g long, seed int"))
    assert sorted(r.pattern for r in found.collect()) == [f"p{k}" for k in range(7)]


def test_pii_finds_long_identifiers(spark):
    long = "-".join(f"{i:04d}AB" for i in range(30))
    made = [(i, f"{prose(20, i)} please contact agent {i}@mail.org now {prose(9, i + 99)}") for i in range(6)]
    made += [(10, f"{prose(20, 10)} please contact agent {long} now {prose(9, 5)}")]
    got = {x.doc_id: x for x in pii.personal_data(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert [made[-1][1][s.start:s.end] for s in got[10].spans if s.kind == "id"] == [long]


@pytest.mark.parametrize("text", [
    "a" * 50_000, "a." * 30_000 + "@" + ".b" * 20_000, "1" * 60_000, "1." * 30_000, "+1" + " " * 50_000, "+1" * 20_000,
    "token" * 10_000, "abcdef0123456789" * 3_000, "a@b.c," * 2_000, "1.2.3.4 567890 " * 4_000,
])
def test_long_texts_take_time_in_proportion(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string").withColumn("source", F.lit("s"))
    got = pii.personal_data(df).first()
    assert [(s.kind, s.start, s.end) for s in got.base] == brute.pii_spans(text)
    found = secrets.secrets(df).first()
    assert [(s.kind, s.start, s.end) for s in found.base] == brute.secret_spans(text)


def test_secrets_by_owner(spark):
    live, shared = "Zk3" + "aB9x" * 8, "Qw7" + "cD4y" * 8
    made = [(i, f"key {shared} here", f"s{i}") for i in range(4)]
    made += [(10, f"é {live} token=abc TOKEN : 'abcdefghijkl1' AKIA{'Z' * 20}", "s1"), (11, None, None), (12, f"password={shared}", "s9")]
    df = spark.createDataFrame(made, "doc_id long, text string, source string")
    got = {x.doc_id: x for x in secrets.secrets(df).collect()}
    text = made[4][1]
    kinds = {s.kind: text[s.start:s.end] for s in got[10].spans}
    assert kinds == {"loose": live, "assign": "TOKEN : 'abcdefghijkl1", "access": "AKIA" + "Z" * 20}
    assert not any(s.copied for s in got[10].spans)
    assert got[0].spans == [] and got[11].spans == []
    # The same value as a password: the base span stays, as a copied one.
    assert [(s.kind, s.copied, s.owners, s.repositories) for s in got[12].spans] == [("assign", True, 5, 5)]


def test_templates():
    turns = [("user", "a\\|<|im_end|>\n"), ("odd\nrole\\n", "<"), ("assistant", ""), ("assistant", "<\\|x")]
    r = chat.render(turns)
    assert r.rewritten_at is None
    read = [(chat.unescape_role(r.output[s.start:s.text_start][len("<|im_start|>"):-1]), chat.unescape(r.output[s.text_start:s.text_end]))
            for s in r.spans]
    assert read == turns and r.spans[-1].end == len(r.output)

    def last_only(turns):  # forgets what was thought before the last turn
        return "".join(t if i == len(turns) - 1 else t[:1] for i, (_, t) in enumerate(turns))

    assert chat.render([("u", "abc"), ("a", "def")], last_only).rewritten_at == 1
    assert chat.render([]).spans == ()


def test_chats_with_nulls_and_ties(spark):
    given = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "a"), (None, None, None, "x"), (2, 0, "user", "y" * 100_000)]
    df = spark.createDataFrame(given, "conv_id long, turn int, role string, text string")
    done = {r.conv_id: r for r in chat.format_chats(chat.conversations(crowded(df))).collect()}
    assert [done[1].formatted[s.text_start:s.text_end] for s in done[1].spans] == ["", "a", "b"]
    assert [s.loss for s in done[1].spans] == [False, True, True]
    assert len(done[None].spans) == 1 and len(done[2].formatted) > 100_000
    none = spark.createDataFrame([], df.schema)
    assert chat.format_chats(chat.conversations(none)).count() == 0


def test_winnowing_finds_every_span_of_ten(spark, items):
    passage = prose(12, 50).split()
    made = []
    for i in range(60):
        r = random.Random(i)
        n, at = r.randrange(0, 15), r.randrange(0, 30)
        start = r.randrange(0, max(1, 13 - n))
        words = prose(30, 1000 + i, "v").split()
        made.append((i, " ".join(words[:at] + [w.upper() for w in passage[start:start + n]] + words[at:])))
    made += [(100, "the TINY, item!"), (101, "tiny  odd item"), (102, "solo"), (103, None), (104, "..."), (104, "tiny item")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    found = winnow.contamination(df, items).collect()
    assert len(found) == len(made)
    texts = [(str(k), brute_words(t)) for k, t in [(1, prose(12, 50)), (2, "tiny item")]] + [(None, ["solo"])]
    want = sorted(repr((k, *brute_hits(brute_words(t), texts))) for k, t in made)
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in found) == want


def brute_words(text):
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def brute_hits(words, items):
    hit, names = set(), set()
    for name, item in items:
        n = min(10, len(item))
        windows = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(name)
    return len(words), len(hit), sorted(n for n in names if n)


def test_no_benchmark_no_hits(spark, docs, items):
    assert winnow.drop_contaminated(docs, items.limit(0)).count() == 11
    assert winnow.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0


def test_order_of_rules_changes_no_verdict(spark, docs):
    texts = [r.text for r in docs.collect()] + [prose(10, 1), "a b c " * 40, "*** " * 80]
    order = quality.order_rules(texts)
    assert sorted(m.rule.name for m in order) == sorted(r.name for r in quality.RULES)
    assert len(quality.order_rules([])) == len(quality.RULES)
    for text in texts:
        reasons = {quality.first_rejection(quality.Document(text), o, quality.RULES)
                   for o in ([m.rule for m in order], quality.RULES, quality.RULES[::-1])}
        assert len(reasons) == 1
        assert reasons.pop() == next((r.name for r in quality.RULES if r.rejects(quality.Document(text))), None)


def test_order_of_rules_is_the_same_every_time(spark, docs):
    texts = [r.text for r in docs.collect()] + [prose(30 * i, i) for i in range(20)]
    orders = {tuple(m.rule.name for m in quality.order_rules(texts)) for _ in range(10)}
    assert len(orders) == 1
    for order in (quality.RULES, quality.RULES[::-1]):
        assert rows(quality.judge(docs, order=order)) == rows(quality.judge(docs))


def test_cheap_rules_that_reject_go_first():
    slow = quality.Rule("slow", lambda d: d.n_repeat_words >= 0 and d.n_words > 1)
    never = quality.Rule("never", lambda d: False)
    fast = quality.Rule("fast", lambda d: d.n_words > 1)
    order = [m.rule.name for m in quality.order_rules([prose(5, i) for i in range(20)], [slow, never, fast])]
    assert order[0] == "fast"


def test_boilerplate_is_relative_to_its_site(spark):
    made = [(i, f"{prose(5, i)}\n  All rights reserved \n\nlast {i}", "en", "big" if i < 40 else "small", 1) for i in range(44)]
    made += [(100 + i, f"{prose(5, 200 + i)}\nrare on big", "en", "big", 1) for i in range(3)]
    made += [(200, "All rights reserved", "en", None, 1), (201, "All rights reserved\nAll rights reserved", "en", "small", 1)]
    # Pages without a host are one site; two pages are the least that repetition means.
    made += [(300 + i, f"{prose(4, 400 + i)}\n{prose(3, 500 + i)}\nfooter of none\nodd {i}", None, None, None) for i in range(2)]
    made += [(310 + i, f"{prose(4, 410 + i)}\nonce more\nodd {i}", "en", f"tiny{i // 2}", 1) for i in range(3)]
    # Copies are made of repeated lines: which of them to keep isn't decided here.
    made += [(320 + i, f"{prose(6, 900)}\n{prose(6, 901)}\nown {i}", "en", "copied", 1) for i in range(4)]
    df = spark.createDataFrame(made, DOCS)
    got = {r.doc_id: r for r in lines.line_report(df, ratio=0.1).collect()}
    assert got[0].text == made[0][1].replace("  All rights reserved \n", "") and got[0].n_dropped == 1
    assert got[41].n_dropped == 1 and got[100].n_dropped == 0
    assert got[200].text == "All rights reserved" and got[201].n_dropped == 0
    assert [got[i].n_dropped for i in (300, 301, 310, 311, 312)] == [1, 1, 1, 1, 0]
    assert [got[i].n_dropped for i in range(320, 324)] == [0] * 4
    alone = {r.doc_id: r for r in lines.line_report(df, ratio=0.1, copy=1.0).collect()}
    assert alone[201].text == "" and alone[320].text == "own 0"


def test_a_page_of_very_many_lines(spark):
    text = "\n".join(f"line {i}" for i in range(60_000))
    df = spark.createDataFrame([(1, text, "en", "a", 1), (2, "line 7\nx", "en", "a", 1)], DOCS)
    got = {r.doc_id: r for r in lines.line_report(df, ratio=0.5, least_pages=2).collect()}
    assert (got[1].n_lines, got[1].n_dropped, got[2].text) == (60_000, 1, "x")


RULES = (urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("block", "net"))


@pytest.mark.parametrize("most_bits", [urls.MOST_BITS, 0])
def test_urls_by_filters_and_by_joins(spark, most_bits):
    made = [(1, "http://WWW.Example.com/en/x?y"), (2, "https://a.net"), (3, "http://b.com"), (4, None), (5, "no scheme"), (6, "x://bad.org#f"),
            (7, "http://sub.bad.org/p"), (8, "http://notbad.org/"), (8, "http://notbad.org/"), (9, "http://" + "a." * 5000 + "com/"), (10, "://"),
            (11, "http://good.org/bad/page?x"), (12, "http://good.org/bad/page/2"), (13, "http://sub.good.org/bad/page")]
    pages = crowded(spark.createDataFrame(made, "page_id long, url string"))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, RULES, ["bad.org", "bad.org", "absent.org", "good.org/bad/page"], most_bits=most_bits).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "www.example.com", "/en/x", "example.com/en/", "block"), (2, "a.net", "", "net", "block"), (3, "b.com", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "bad.org", "", None, "block"), (7, "sub.bad.org", "/p", None, "block"),
        (8, "notbad.org", "/", None, "allow"), (8, "notbad.org", "/", None, "allow"), (9, "a." * 5000 + "com", "/", "com/", "allow"), (10, "", "", None, "allow"),
        (11, "good.org", "/bad/page", None, "block"), (12, "good.org", "/bad/page/2", None, "allow"), (13, "sub.good.org", "/bad/page", None, "allow"),
    ], key=str)
    assert urls.judge_urls(pages.limit(0), RULES, ["bad.org"], most_bits=most_bits).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = keys.select("key", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))
    cascade = urls.build_cascade(universe, keys.where("substring(key, -1) = '3'"))
    h, g, key = (universe.toArrow().column(c).to_numpy() for c in ("h", "g", "key"))
    found = cascade.contains(h.view(np.uint64), g.view(np.uint64))
    assert len(cascade.levels) > 1
    assert (found == np.array([k.endswith("3") for k in key])).all()
