"""The queries over the smallest tables, against SQL or plain Python."""

import functools
import math
from collections import Counter

import brute
import numpy as np
import pytest

from checks.compare import compare, duck
from vacancia.llm import queries as q
from vacancia.llm import scoring, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_against_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name, q.QUERIES[name], q.ORACLES[name])
    assert ok, note


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES) == list(range(1, 14))


def groups(prints):
    """Smallest key reachable over links of at most two bits, by comparing all with all."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_op2(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in q.QUERIES["op2_simhash_pivots"](spark, SF).collect()}
    prints = {k: simhash.fingerprint(t) for k, t in docs.items()}
    roots = groups(prints)
    assert got == {k: (f"{prints[k]:016x}", roots[k]) for k in docs}


def test_op3(spark, con, docs):
    """The same models counted with dictionaries."""
    good = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0").fetchall()}
    fold = {b: b + 32 if 65 <= b <= 90 else b for b in range(256)}
    tokens = {k: [0xFF] * 3 + [fold[b] for b in (t or "").encode()] for k, t in docs.items()}
    # Which half a text is in is read from the operator; that copies share one is tested apart.
    labels = spark.createDataFrame([(k,) for k in good], "doc_id long")
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    halves = {r.key: r.part for r in scoring.prepared(table, labels).collect()}
    assert {k for k, part in halves.items() if part} == good & set(docs) and set(halves.values()) == {0, 1, 2}
    half_of = {docs[k]: part for k, part in halves.items() if part}
    counts = {part: Counter() for part in range(3)}
    for k, t in tokens.items():
        for i in range(3, len(t)):
            for n in range(1, 5):
                counts[halves[k]][tuple(t[i - n + 1:i + 1])] += 1
    counts["target"] = counts[1] + counts[2]
    contexts = {}
    for part, found in counts.items():
        c = contexts[part] = Counter()
        for gram, n in found.items():
            c[gram[:-1]] += n
    scale = {part: contexts["target"][()] / contexts[part][()] for part in counts}

    @functools.cache
    def p(part, gram):
        shorter = p(part, gram[1:]) if len(gram) > 1 else 1 / scoring.SYMBOLS
        s = scale[part]
        return (s * counts[part][gram] + scoring.PRIOR * shorter) / (s * contexts[part][gram[:-1]] + scoring.PRIOR)

    got = {r.doc_id: r for r in q.QUERIES["op3_cross_entropy_difference"](spark, SF).collect()}
    assert set(got) == set(docs)
    for k, t in tokens.items():
        n = len(t) - 3
        assert got[k].n_tokens == n
        if not n:
            assert got[k].target_loss is got[k].background_loss is got[k].difference is None
            continue
        # The model that didn't see the text: the other half's, or that of both.
        models = {0: "target", 1: 2, 2: 1}[half_of.get(docs[k], 0)], 0
        losses = [-sum(math.log(p(m, tuple(t[i - 3:i + 1]))) for i in range(3, len(t))) / n for m in models]
        assert got[k].target_loss == pytest.approx(losses[0], abs=1e-5)
        assert got[k].background_loss == pytest.approx(losses[1], abs=1e-5)
        assert got[k].difference == pytest.approx(losses[0] - losses[1], abs=1e-5)


def test_op3_labelled_copies_share_a_half(spark):
    rows = [(i, f"text number {i % 7} of several") for i in range(70)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = scoring.prepared(table, table.select("doc_id")).collect()
    assert len(found) == 70 and {r.part for r in found} == {1, 2}
    assert len({(r.key % 7, r.part) for r in found}) == 7


def test_op3_separates_held_out_labels(spark, con):
    """Models of half of the labelled documents rank the other half."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = labels.where("doc_id % 2 = 0 and quality = 1 and toxic = 0")
    scored = scoring.score_against(docs, known).join(labels.where("doc_id % 2 = 1"), "doc_id").where("n_tokens >= 300")
    rows = [(r.difference, r.quality) for r in scored.collect()]
    good, bad = [d for d, y in rows if y == 1], [d for d, y in rows if y == 0]
    assert np.mean([g < b for g in good for b in bad]) > 0.7


def test_op4(spark, docs):
    for r in q.QUERIES["op4_bootstrapped_pii"](spark, SF).collect():
        spans = brute.pii_spans(docs[r.doc_id])
        kinds = Counter(s[0] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == brute.sha(brute.joined(spans))
        assert {s for s in r.spans.split(",") if s} >= {f"{k}:{a}:{b}" for k, a, b in spans}


def test_op5(spark, docs):
    for r in q.QUERIES["op5_secret_ownership"](spark, SF).collect():
        spans = brute.secret_spans(docs[r.doc_id])
        kinds = Counter(s[0] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in ("assign", "access", "hex"))
        assert r.base_sha256 == brute.sha(brute.joined(spans))
        assert {s for s in r.spans.split(",") if s} >= {f"{k}:{a}:{b}" for k, a, b in spans}


def test_op6(spark, con):
    rows = con.execute("SELECT conv_id, turn, role, coalesce(text, '') FROM conversations ORDER BY 1, 2").fetchall()
    chats = {-1: [("user", q._CONTROL), ("assistant", q._CONTROL)]}
    for conv, _, role, text in rows:
        chats.setdefault(conv, []).append((role, text))
    got = q.QUERIES["op6_incremental_rendering"](spark, SF).collect()
    assert sorted(r.conv_id for r in got) == sorted(chats)
    for r in got:
        turns = chats[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for role, t in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))
        assert r.formatted_chars > sum(len(role) + len(t) for role, t in turns)


def test_op8(spark, docs):
    for r in q.QUERIES["op8_rule_cascade"](spark, SF).collect():
        text = docs[r.doc_id] or ""
        words = brute.WORD.findall(text)
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        windows = Counter(zip(words, words[1:], words[2:]))
        inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(inside))
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        assert r.base_failed == failed
        chars, letters = r.word_chars, sum(c.isalpha() and c.isascii() or not c.isascii() for c in text.encode().decode("latin1"))
        rejected = (
            failed or 100 * r.n_symbols > 20 * len(words) or 100 * r.n_dup_lines > 50 * len(lines)
            or not 2 * len(words) <= chars <= 15 * len(words) or 100 * letters < 50 * chars
        )
        assert r.kept == (not rejected)
