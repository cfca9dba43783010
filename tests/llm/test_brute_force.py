"""Operators against brute force on small tables, and models on rows that they did not learn from."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from furrow.llm import decontaminate, html_extract, ivfpq, jaccard_join, language, licenses, lm_scoring, packing, pii, toxicity
from furrow.llm.common import bitmap, components, in_bitmap


def words(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def shingles(text):
    w = text.encode().lower().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def linked(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def test_jaccard_with_crowds_and_shared_passages(spark):
    """A crowd of 150 near copies with 0 to 12 changed words, a passage in half of all texts, copies, chains and short texts."""
    r = random.Random(1)
    base, passage = words(r, 90).split(), words(r, 60)
    texts = {}
    for i in range(150):
        t = list(base)
        for _ in range(r.randint(0, 6)):
            t[r.randrange(len(t))] = words(r, 1)
        texts[i] = " ".join(t)
    for i in range(150, 320):
        texts[i] = (passage + " " if i % 2 else "") + words(r, r.randint(1, 120))
    for i in range(320, 360):
        texts[i] = texts[r.randrange(320)] if i % 2 else words(r, r.randint(0, 6))
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in jaccard_join.join(df).collect()}
    assert got == linked(texts)


def plain_links(sets):
    plain = jaccard_join.Forest(len(sets))
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            plain.join(i, j)
    return [plain.find(i) for i in range(len(sets))]


def by_cells(sets, count=None):
    forest = jaccard_join.Forest(len(sets))
    for i, j in jaccard_join.cell_links(sets, count)[0]:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
        forest.join(i, j)
    return [forest.find(i) for i in range(len(sets))]


def test_cells_and_windows_are_exact():
    """Clusters whose members lie up to 1/2 apart, so that cells meet and boundary documents are replicated."""
    r = np.random.default_rng(2)
    count = collections.Counter()
    for _ in range(40):
        sets = []
        for c in range(int(r.integers(1, 7))):
            core = np.arange(c * 1000, c * 1000 + int(r.integers(8, 60)))
            for _ in range(int(r.integers(1, 30))):
                drop = int(r.integers(0, len(core) // 2))
                keep = np.delete(core, r.choice(len(core), drop, replace=False))
                sets.append(np.sort(np.concatenate([keep, r.integers(10**6, 10**9, r.integers(0, 8))]).astype(np.int64)))
        if len(sets) > 1:
            assert by_cells(sets, count) == plain_links(sets)
    assert count["replicated"] > 100


def test_a_crowd_of_copies_is_one_cell():
    """1,500 near copies of one text: hardly more comparisons than documents."""
    r = np.random.default_rng(3)
    sets = [np.sort(np.concatenate([np.delete(np.arange(200), r.choice(200, r.integers(0, 12), replace=False)), r.integers(10**6, 10**9, 3)]).astype(np.int64)) for _ in range(1500)]
    count = collections.Counter()
    assert set(by_cells(sets, count)) == {0}
    assert count["compared"] < 4 * len(sets)


def test_a_chain_of_shared_passages_is_not_all_pairs():
    """60 groups of 20 documents; a passage is shared by two neighbouring groups, and no two documents link."""
    r = np.random.default_rng(4)
    sets = [np.sort(np.concatenate([np.arange(g * 100, g * 100 + 56), np.arange(g * 100 + 100, g * 100 + 156), r.integers(10**6, 10**9, 25)]).astype(np.int64)) for g in range(60) for _ in range(20)]
    few = [s for s in sets[:200]]
    assert by_cells(few) == plain_links(few)
    count = collections.Counter()
    by_cells(sets, count)
    assert count["compared"] < len(sets) ** 2 / 8


@pytest.mark.parametrize("spread", [4, 14])
def test_blocks_of_a_large_region(spark, monkeypatch, spread):
    """Near copies and chains of them, some of which link with nothing, in rounds over blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 12)
    monkeypatch.setattr(jaccard_join, "CROWD", 4)
    monkeypatch.setattr(jaccard_join, "LEVELS", (4, 30, 100))
    r = random.Random(3)
    base = words(r, 60).split()
    texts = {}
    for i in range(150):
        t = list(base)
        for _ in range(r.randint(0, spread)):
            t[r.randrange(len(t))] = words(r, 1)
        texts[i] = " ".join(t)
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    want = linked(texts)
    assert {x.doc_id: x.component_id for x in jaccard_join.join(df).collect()} == want
    assert len(set(want.values())) > (1 if spread > 4 else 0)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 540)] + [(7, 3), (3, 7), (9, 9)]
    got = {x.id: x.component_id for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 181))
    assert all(got[i] == 500 for i in range(500, 540))
    assert (got[7], got[3]) == (3, 3)


def test_bitmap(spark):
    values = [5, -1, 2**62, 0]
    bits = bitmap(spark.createDataFrame([(v,) for v in values] + [(None,)], "v long"), "v")
    assert in_bitmap(bits, np.array(values)).all()
    assert in_bitmap(bits, np.arange(10**6, 10**6 + 1000)).sum() < 5


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m[0])]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.@+-() ab_%,é\n", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_known_cases():
    t = "x 4539 1488 0343 6467, 1.2.3.4.5.6.7.8 a@b@c.de +1 (555) 010-2030. 300.1.1.1 00001.2.3.4"
    assert pii.base_spans(t) == plain_spans(t)
    assert pii.base_spans("1" * 50_000 + "@" * 50_000 + "a" * 50_000) == []


def test_crf_finds_what_patterns_miss_and_keeps_the_base():
    crf = pii.trained()
    cases = {
        "call (717) 555-0202 now": ["phone"],
        "mail bob (at) mail (dot) org today": ["email"],
        'api token = "0a1b2c3d4e5f60718293a4b5c6d7e8f9"': ["secret"],
        "on page 12 the 1990 report of 16 items": [],
        "+1 (717) 555-0202": ["phone"],
        "Contact Mr Johann Schneider, 12 Baker Street, London": ["name", "address"],
        "jane dot doe at gmail dot com": ["email"],
        "717 555 0202": ["phone"],
        "SSN 123-45-6789": ["id"],
        "sk-0a1b2c3d4e5f60718293a4b5": ["secret"],
        "tel. 0049 30 1234567": ["phone"],
    }
    found = pii.find(list(cases), crf)
    assert [[k for k, _, _ in every] for _, every in found] == list(cases.values())
    text = "mail bob (at) mail (dot) org today"
    assert pii.mask(text, pii.find([text], crf)[0][1]) == "mail <email> today"


def spans_of(labels):
    out, t = set(), 0
    while t < len(labels):
        u = t + 1
        if labels[t] != "O":
            while u < len(labels) and labels[u] == f"I-{labels[t][2:]}":
                u += 1
            out.add((labels[t][2:], t, u))
        t = u
    return out


def test_crf_on_lines_that_it_did_not_learn_from():
    lines = pii.table_lines()
    crf = pii.fit(pii.labelled_sentences(lines=[x for i, x in enumerate(lines) if i % 5 != 2]))
    held = pii.labelled_sentences(8, seed=99, lines=[x for i, x in enumerate(lines) if i % 5 == 2])
    hit = found = there = 0
    for (_, labels), got in zip(held, crf.decode([w for w, _ in held], crf.memory()), strict=True):
        a, b = spans_of(labels), spans_of([pii.LABELS[k] for k in got])
        hit, found, there = hit + len(a & b), found + len(b), there + len(a)
    print(f"held-out spans: precision {hit / found:.2f}, recall {hit / there:.2f}")
    assert hit >= 0.85 * found
    assert hit >= 0.7 * there


def test_crf_decoding_is_the_best_path(monkeypatch):
    """Every path of short texts, in one batch with longer ones; and of a text that is decoded in pieces, nothing changes."""
    crf = pii.trained()
    seqs = [["call", "(717)", "555-0202"], ["x"], ["token", "=", '"0a1b2c3d4e5f60718293"'], []]
    scores, size = crf.scores(seqs, crf.memory())
    got = crf.decode(seqs, crf.memory())
    for seq, at, y in zip(seqs, np.cumsum(size) - size, got, strict=True):
        s = scores[at : at + len(seq)]
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(seq)), key=lambda y: sum(s[t, k] for t, k in enumerate(y)) + sum(crf.move[a, b] for a, b in itertools.pairwise(y)))
        assert y.tolist() == list(best)
    r = random.Random(12)
    long = [w for _ in range(60) for w in r.choice(pii.labelled_sentences(1))[0]]
    whole = crf.decode([long], crf.memory())[0]
    monkeypatch.setattr(pii, "SEQUENCE", 100)
    monkeypatch.setattr(pii.Memory, "LIMIT", 50)
    memory = crf.memory()
    assert all((crf.decode([long], memory)[0] == whole).all() for _ in range(2))


def test_crf_gradient_is_that_of_the_log_likelihood():
    """A step of the fit moves against the difference quotient of the likelihood, summed over all labellings."""
    data = [(["tel", "717", "now"], ["O", "B-phone", "O"]), (["a", "b"], ["O", "O"])] * 2
    one = pii.fit(data, rounds=1, l2=0.0, rate=1e-3)

    def loss(crf):
        total = 0.0
        for words, labels in data:
            s, _ = crf.scores([words], crf.memory())
            paths = {y: sum(s[t, k] for t, k in enumerate(y)) + sum(crf.move[a, b] for a, b in itertools.pairwise(y)) for y in itertools.product(range(len(pii.LABELS)), repeat=len(words))}
            total += paths[tuple(pii.LABELS.index(x) for x in labels)] - np.logaddexp.reduce(np.array(list(paths.values())))
        return total

    zero = pii.CRF(one.index, one.emit * 0, one.move * 0, one.again * 0)
    base = loss(zero)
    assert loss(one) > base
    r = np.random.default_rng(3)
    for _ in range(40):  # Adam's first step is the gradient's sign
        j, f, k = (r.integers(n) for n in one.emit[:, :-1].shape)
        if abs(one.emit[j, f, k]) > 1e-9:
            emit = zero.emit.copy()
            emit[j, f, k] = 1e-2
            assert np.sign(loss(pii.CRF(one.index, emit, zero.move, zero.again)) - base) == np.sign(one.emit[j, f, k])
    for a, b in itertools.product(range(3), repeat=2):
        if abs(one.move[a, b]) > 1e-9:
            move = zero.move.copy()
            move[a, b] = 1e-2
            assert np.sign(loss(pii.CRF(one.index, zero.emit, move, zero.again)) - base) == np.sign(one.move[a, b])


def test_pii_digest(spark):
    row = pii.detect(spark.createDataFrame([(1, "a@b.de é 1.2.3.4")], "doc_id long, text string")).first()
    assert row.base_sha256 == hashlib.sha256(b"email:0:6,ip:9:16").hexdigest()
    assert row.spans == "email:0:6,ip:9:16"


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(4)
    size = np.array([3, 0, 5, 1])
    first = np.cumsum(size) - size
    scores = r.normal(size=(9, 3))
    got = language.viterbi(scores, first, size, 0.7)
    for f, n in zip(first, size, strict=True):
        if n:
            best = max(itertools.product(range(3), repeat=int(n)), key=lambda y: sum(scores[f + t, k] for t, k in enumerate(y)) - 0.7 * sum(a != b for a, b in itertools.pairwise(y)))
            assert got[f : f + n].tolist() == list(best)


def test_language_held_out_and_mixed(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = language.op3_language_id(spark, small).join(docs, "doc_id").where("held_out")
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()
    de = "und der die das ist nicht ein eine mit von auf für sich " * 4
    en = "the of and to in is that for with as was by on are " * 4
    train = spark.createDataFrame([(1, de, "de"), (2, en, "en"), (3, "это не так и что он на с как по " * 9, "ru")], "doc_id long, text string, lang string")
    row = language.identify(spark.createDataFrame([(9, de + en + "он не как это что")], "doc_id long, text string"), train).first()
    assert [s.lang for s in row.spans] == ["de", "en", "ru"]


def test_passages_against_brute_force(spark):
    r = random.Random(5)
    items = [(i, words(r, r.randint(12, 60))) for i in range(30)]
    docs, truth = [], set()
    for d in range(60):
        body = words(r, 40)
        if d % 2:
            i, t = items[d % 30]
            t = list(t)
            for _ in range(int(decontaminate.EDIT_RATE * len(t)) * (d % 4 == 1)):
                t[r.randrange(len(t))] = r.choice("xyz")
            body += "  " + "".join(t).upper() + "\n" + words(r, 20)
            truth.add((d, i))
        docs.append((d, body))
    found = decontaminate.find_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in found.collect()} == truth


def plain_features(word):
    """Hashed 3-grams, 4-grams and the word itself, letter by letter."""
    c, m = [ord(x) for x in word], 1 << 32
    a = [0, *c, 0, 0]
    tri = [((a[i] * 2654435761 + a[i + 1] * 2246822519 + a[i + 2] * 3266489917) % m) >> 14 for i in range(len(c))]
    four = [((a[i] * 668265263 + a[i + 1] * 374761393 + a[i + 2] * 2869860233 + (a[i + 3] * 3624381081 if a[i + 2] else 0)) % m) >> 14 for i in range(len(c))]
    h = sum(x * ((((i + 1) * 2654435769) % m) | 1) for i, x in enumerate(c)) % m
    return tri, four, ((((h * 2654435761) % m) ^ (h >> 15)) % m) >> 14


def test_word_scores_against_a_plain_version():
    """Naive Bayes over a word's features, words whose script excludes a language, and the whole path by trying all labellings."""
    r = np.random.default_rng(5)
    langs = ["de", "en", "ru"]
    weights = r.normal(size=(language.BUCKETS, 3)).astype(np.float32)
    allowed = np.ones((len(language.SCRIPTS) + 1, 3), bool)
    allowed[1, 2] = False  # no Latin in ru
    allowed[3, :2] = False  # Cyrillic in ru only
    m = language.Model(langs, weights, allowed, np.full(3, 1 / 3))
    items = ["Ab c, дом über12x", "", "1 2", "xx YY zz. что это"]
    w = language.words_of(items)
    got = language._score(w, m)
    flat = [(d, x.lower()) for d, t in enumerate(items) for x in re.findall(r"[^\W\d_]+", t)]
    assert [d for d, _ in flat] == w.doc.tolist()
    for (_, word), row in zip(flat, got, strict=True):
        tri, four, whole = plain_features(word)
        plain = weights[tri].sum(0) + weights[four].sum(0) + weights[whole]
        may = allowed[3 if word[0] > "z" and word[0] not in "ü" else 1]
        assert row == pytest.approx(np.where(may, plain, plain - 1000), abs=1e-3)
    out = language._label(m, __import__("pyarrow").array([1, 2, 3, 4]), items, 2.0, True).to_pylist()
    for d, x in enumerate(out):
        own = got[[k for k, (e, _) in enumerate(flat) if e == d]]
        if not len(own):
            assert (x["lang_pred"], x["score"], x["spans"]) == ("und", 0.0, [])
            continue
        best = max(itertools.product(range(3), repeat=len(own)), key=lambda y: sum(own[t, k] for t, k in enumerate(y)) - 2.0 * sum(a != b for a, b in itertools.pairwise(y)))
        runs = [langs[k] for k, _ in itertools.groupby(best)]
        assert [s["lang"] for s in x["spans"]] == runs
        share = collections.Counter()
        for (_, word), k in zip([f for f in flat if f[0] == d], best, strict=True):
            share[langs[k]] += len(word)
        assert x["score"] == pytest.approx(max(share.values()) / sum(share.values()))


def test_long_texts_in_pieces_are_labelled_alike(monkeypatch):
    r = random.Random(2)
    text = " ".join(r.choice(["und", "der", "this", "that", "это", "что", "x" * 300, "12"]) for _ in range(3000))
    weights = np.random.default_rng(1).normal(size=(language.BUCKETS, 2)).astype(np.float32)
    m = language.Model(["a", "b"], weights, np.ones((len(language.SCRIPTS) + 1, 2), bool), np.array([0.5, 0.5]))
    ids = __import__("pyarrow").array([1, 2])
    whole = language._label(m, ids, [text, "und x"], 3.0, True).to_pylist()
    monkeypatch.setattr(language, "PIECE_CHARS", 1000)
    assert language._label(m, ids, [text, "und x"], 3.0, True).to_pylist() == whole
    assert len(whole[0]["spans"]) > 1


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def codes(t):
    return np.array([ord(c) for c in t], dtype=np.uint32)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=12), st.text(alphabet="abc", max_size=20)), min_size=1, max_size=4), st.integers(0, 4), st.booleans())
def test_alignment_is_the_least_edit_distance(pairs, budget, backward):
    """Several passages side by side, each against its own text, in a band that holds all of it."""
    code = codes("".join(t for _, t in pairs) + "z")
    base = np.cumsum([0] + [len(t) for _, t in pairs])
    first = np.array([lo - len(p) for (p, _), lo in zip(pairs, base, strict=False)])
    wide = max(len(t) + 2 * len(p) for p, t in pairs) + 1
    many = lambda x: np.full(len(pairs), x)
    got = decontaminate.align([codes(p) for p, _ in pairs], code, first, wide, base[:-1], base[1:], many(budget), many(True) if backward else None)
    for (p, t), lo, (e, start, end) in zip(pairs, base.tolist(), got.tolist(), strict=False):
        best = min(edits(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))
        assert e == (best if best <= budget else -1)
        if e >= 0 and not backward:
            inside = code[max(start, lo) : max(min(end, lo + len(t)), max(start, lo))]
            assert edits(p, "".join(map(chr, inside))) <= e + max(0, lo - start) + max(0, end - lo - len(t))


def near(p, t, budget):
    """Sellers' algorithm: whether some stretch of t is within budget edits of p."""
    row = np.zeros(len(t) + 1, dtype=int)
    c = codes(t)
    for x in p:
        new = np.concatenate([[row[0] + 1], np.minimum(row[:-1] + (c != ord(x)), row[1:] + 1)])
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return row.min() <= budget


def test_all_pairs_of_passages_and_texts(spark, monkeypatch):
    """Short, shared and edited passages of 3 to 900 characters against every text, counted and aligned in small slices."""
    monkeypatch.setattr(decontaminate, "POSTINGS", 50)
    monkeypatch.setattr(decontaminate, "CELLS", 3000)
    r = random.Random(15)
    head = "which of the following statements about abcd is"
    items = [f"{head} {words(r, r.randint(1, 8))}" for _ in range(25)] + [words(r, n) for n in (1, 2, 3, 4, 6, 9, 100, 180)] + ["abcd", "ab ab ab ab ab ab ab ab ab ab", "."]
    docs = []
    for k in range(70):
        body = [words(r, r.randint(0, 20))]
        for _ in range(k % 4):
            t = list(r.choice(items))
            for _ in range(int(r.choice([0, 0.02, 0.06, 0.09]) * len(t))):
                how, at = r.random(), r.randrange(len(t))
                t[at : at + (how < 0.7)] = [] if how < 0.2 else [r.choice("abxy")]
            body += ["".join(t), words(r, r.randint(0, 5))]
        docs.append(" ".join(body))
    docs += [f"{head} {head} {head}", "", "x"]
    index = decontaminate.Index(list(enumerate(items)))
    got = index.search([decontaminate.normal(t) for t in docs])
    want = set()
    for d, t in enumerate(docs):
        t = decontaminate.normal(t)
        for i, p in enumerate(items):
            m = len(p)
            if m < decontaminate.Q:
                if re.search(rf"(?<![a-z0-9]){re.escape(p)}(?![a-z0-9])", t):
                    want.add((d, i))
            elif near(p, t, min(int(decontaminate.EDIT_RATE * m), (m - decontaminate.Q) // decontaminate.Q)):
                want.add((d, i))
    assert {(d, i) for d, i, *_ in got} == want
    for d, i, start, end, e in got:
        assert edits(items[i], decontaminate.normal(docs[d])[start:end]) == e
    assert {d for d, *_ in index.search([decontaminate.normal(t) for t in docs], all_places=False)} == {d for d, _ in want}


def test_every_place_and_blocks_of_passages(spark):
    r = random.Random(16)
    items = [(i, words(r, 20)) for i in range(12)]
    text = " ".join([words(r, 9), items[3][1], words(r, 4), items[3][1], items[5][1]])
    df, bench = spark.createDataFrame([(1, text), (2, words(r, 50))], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.find_passages(df, bench).collect()))
    assert [(d, i) for d, i, *_ in one] == [(1, 3), (1, 3), (1, 5)]
    assert sorted(map(tuple, decontaminate.find_passages(df, bench, block_chars=300).collect())) == one


def test_a_shared_head_is_no_burden():
    """8,000 passages with one head, and a text that holds the head 30 times: seconds and bounded memory."""
    import time
    import tracemalloc

    r = random.Random(17)
    head = "which of the following statements about the passage above is right and"[:70]
    items = [(i, f"{head} {words(r, 6)}") for i in range(8000)]
    text = " ".join(f"{head} {words(r, 28)}" for _ in range(30)) + " " + items[77][1]
    index = decontaminate.Index(items)
    tracemalloc.start()
    began = time.time()
    got = index.search([decontaminate.normal(text)])
    assert {i for _, i, *_ in got} == {77}
    assert time.time() - began < 30
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()


def recall(rows, got, k=10):
    """Share of the exact neighbours that got has; scores and ranks are checked on the way."""
    ids, vec = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((vec - vec[ids == q][0]) ** 2).sum(1))
        best = [int(i) for i in ids[np.lexsort((ids, d))] if i != q][:k]
        hits += len(set(best) & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert all(abs(s - d[ids == v][0]) < 1e-12 for _, v, s in found)
        assert found == sorted(found, key=lambda x: (x[2], x[1]))
    return hits / (k * len(got))


def answers(df):
    got = collections.defaultdict(list)
    for x in df.orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    return got


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_neighbours_recall(spark, sf):
    d = f"/root/testdata/sf{sf}"
    rows = [(x.vec_id, x.embedding) for x in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = answers(ivfpq.op5_ivfpq(spark, d))
    assert set(got) == {i for i, _ in rows if i % 100 == 0}
    assert recall(rows, got) >= 0.9


def test_neighbours_of_outlying_queries(spark):
    """Queries that lie apart from the vectors and from each other, many more lists than a query's neighbours fill."""
    r = np.random.default_rng(16)
    centres = r.normal(size=(20, 12)) * 4
    rows = [(i, (r.normal(size=12) * (6 if i % 10 == 0 else 1) + centres[i % 20]).astype(np.float32).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert recall(rows, answers(ivfpq.search(df, F.col("vec_id") % 10 == 0))) >= 0.9
    assert recall(rows, answers(ivfpq.search(df, F.col("vec_id") % 10 == 0, exact=True))) == 1
    assert recall(rows, answers(ivfpq.search(df, F.col("vec_id") % 10 == 0, k=30)), 30) >= 0.9


def test_neighbours_in_lists_of_thousands(spark, monkeypatch):
    """Few long lists, in chunks, where codes decide what is measured."""
    monkeypatch.setattr(ivfpq, "MAX_LISTS", 4)
    monkeypatch.setattr(ivfpq, "CHUNK", 1500)
    r = np.random.default_rng(17)
    rows = [(i, x.tolist()) for i, x in enumerate((r.normal(size=(8000, 4)) @ r.normal(size=(4, 24)) + 0.3 * r.normal(size=(8000, 24))).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert recall(rows, answers(ivfpq.search(df, F.col("vec_id") % 200 == 0))) >= 0.9


def test_neighbours_by_length_and_of_thin_lists(spark, monkeypatch):
    """Two lengths of vectors; and far-off lists with fewer than k vectors."""
    monkeypatch.setattr(ivfpq, "MIN_PROBES", 1)
    r = np.random.default_rng(18)
    rows = [(i, (r.normal(size=6) * 0.01 + (100 if i < 3 else 0)).tolist()) for i in range(200)]
    other = [(1000 + i, r.normal(size=3).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows + other, "vec_id long, embedding array<double>")
    got = answers(ivfpq.search(df, F.expr("vec_id = 0 or vec_id = 50 or vec_id = 1000"), reach=0.2))
    assert {q: len(x) for q, x in got.items()} == {0: 10, 50: 10, 1000: 10}
    assert recall(rows, {0: got[0]}) == 1
    assert recall(other, {1000: got[1000]}) >= 0.9


def test_neighbours_with_many_copies(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(40, 8)).astype(np.float32)
    rows = [(i, base[0 if i % 3 == 0 else i % 40].tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for x in ivfpq.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    vec = np.array([v for _, v in rows])
    for q in range(0, 600, 100):
        d = np.sqrt(((vec - vec[q]) ** 2).sum(1))
        assert got[q] == [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]


def test_html_on_generated_pages():
    trees, w, good = html_extract.train(), html_extract.Writer(77), 0
    for _ in range(150):
        p = html_extract.Page(w.page())
        keep = html_extract.decode(p.parent, trees.logits(p.features()[0]))
        wanted = [x for x in p.text(np.ones(len(p.tag), bool)).split() if x[0] == "k"]
        good += wanted == p.text(keep).split()
    assert good >= 130


def test_html_decoding_is_hierarchical_and_best():
    r = np.random.default_rng(7)
    parent = [-1, 0, 0, 1, 1, 2, 3]
    for _ in range(20):
        logit = r.normal(size=7) * 2
        cost = lambda keep: sum(-np.logaddexp(0, -x) if k else -np.logaddexp(0, x) for x, k in zip(logit, keep, strict=True))  # noqa: E731, B023
        allowed = [k for k in itertools.product([False, True], repeat=7) if all(not k[i] or parent[i] < 0 or k[parent[i]] for i in range(7))]
        assert cost(html_extract.decode(parent, logit).tolist()) == pytest.approx(max(map(cost, allowed)))


def test_html_pages(spark, small):
    for x in html_extract.op6_html_extract(spark, small).join(spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html"), "page_id").collect():
        import html

        body = re.split(r"</?(?:p|h1|br)>", re.sub("</?b>", "", re.search("<article>(.*?)</article>", x.html, re.S)[1]))
        assert x.text == " ".join(" ".join(html.unescape(b).split()) for b in body if b.strip())


def plain_licenses(text):
    """Every window of every template, one by one, from the definition."""
    w = licenses.template_words(text)
    grams, good = list(itertools.pairwise(w)), []
    for name, t in licenses.TEMPLATES.items():
        tw = licenses.template_words(t)
        b = set(itertools.pairwise(tw))
        if sum(g in b for g in set(grams)) * (2 - licenses.THRESHOLD) < licenses.THRESHOLD * len(b) - 1e-9:
            continue
        own = []
        for p in [k for k, g in enumerate(grams) if g in b]:
            for length in {max(1, int((len(tw) - 1) * x + 0.5)) for x in licenses.LENGTHS}:
                win = grams[p : p + length]
                at = [k for k, g in enumerate(win) if g in b]
                both = len({win[k] for k in at})
                dice = 2.0 * both / (both + len(win) - len(at) + len(b))
                if dice >= licenses.THRESHOLD:
                    own.append((-dice, p, length, p + at[-1], len(b), name))
        good += [x for x in own if not any(2 * abs(y[1] - x[1]) <= len(b) and y[:3] < x[:3] for y in own)]
    wins, over = collections.Counter(), collections.defaultdict(list)
    for d, p, _, last, size, name in good:
        for k in range(p, last + 1):
            over[k].append((d, -size, name, p, last))
    for x in over.values():
        wins[min(x)] += 1
    return {(name, p, last + 2, -d) for (d, _, name, p, last), n in wins.items() if 2 * n >= last - p + 1}


def test_licenses_against_brute_force(spark):
    """Whole and edited licences, in running lines and between lines of code; two texts under one id and under null."""
    r = random.Random(8)
    rows = []
    for k, t in enumerate(licenses.TEMPLATES.values()):
        w = t.split()
        for j in range(4):
            v = list(w)
            for _ in range(j * len(w) // 20):
                v[r.randrange(len(v))] = r.choice(["zzz", "the"])
            at = r.randrange(len(v))
            v[at:at] = ["inserted"] * r.choice([0, 0, 1, len(w) // 6])
            rows.append((1000 if j == 1 else None if j == 2 else k * 10 + j, words(r, 30) + "\n\n" + " ".join(v).replace(". ", ".\n\n") + " " + words(r, 9)))
    code = "\n".join(f"let v{i} = call_{i}(a, b);" for i in range(60))
    text = licenses.TEMPLATES["MIT text"].replace(". ", ".\n\n")
    rows += [(5000, f"Copyright me\n\n{text}\n{code}"), (5001, "This library is free to use. Released under the MIT License. See docs for more."), (5002, code)]
    half = licenses.TEMPLATES["GPL-3.0 reference"].split()
    for i in (7, None):
        rows += [(i, " ".join(half[:6])), (i, " ".join(half[6:]))]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    got = sorted((str(x.doc_id), x.license, x.start_word, x.end_word, x.dice) for x in licenses.scan(df).collect())
    assert got == sorted((str(i), *x) for i, t in rows for x in plain_licenses(t))
    assert {x[1] for x in got if x[0] == "5000"} == {"MIT text"}
    assert {x[1] for x in got if x[0] == "5001"} == {"MIT reference"}
    assert not [x for x in got if x[0] in ("5002", "7")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), min_size=1, max_size=8, unique_by=lambda x: x[0]), st.integers(1, 4))
def test_bucket_boundaries_are_optimal(hist, k):
    hist.sort()
    xs, ns = [x for x, _ in hist], [n for _, n in hist]

    def waste(bounds):
        return sum((min(b for b in bounds if b >= x) - x) * n for x, n in hist)

    best = min(waste((*c, xs[-1])) for m in range(k) for c in itertools.combinations(xs[:-1], m))
    got = packing.boundaries(xs, ns, k)
    assert len(got) <= k
    assert got[-1] == xs[-1]
    assert waste(got) == best


def test_packing_fills_batches(spark, small):
    got = packing.op8_packing(spark, small).collect()
    assert len(got) == spark.read.parquet(f"{small}/documents.parquet").count()
    batches = collections.defaultdict(list)
    for x in got:
        assert x.n_tokens <= x.bucket_len
        batches[x.bucket, x.batch].append(x)
    for rows in batches.values():
        assert len(rows) == 1 or len(rows) * rows[0].bucket_len <= packing.TOKEN_BUDGET
        assert sorted(x.place for x in rows) == list(range(len(rows)))
    for b in {k for k, _ in batches}:
        own = sorted(k for j, k in batches if j == b)
        assert own == list(range(len(own)))
        cap = max(1, packing.TOKEN_BUDGET // max(batches[b, 0][0].bucket_len, 1))
        assert all(len(batches[b, k]) == cap for k in own[:-1])


def test_lm_against_a_plain_model(spark):
    texts = {1: "a b a c", 2: "b b d", 3: "A b c", 4: ""}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x for x in lm_scoring.score(df, spark.createDataFrame([(1,), (1,)], "doc_id long")).collect()}
    toks = {i: re.findall("[^ ]+", t.lower()) for i, t in texts.items()}
    v = len({w for t in toks.values() for w in t}) + 2

    def loss(docs, tokens):
        uni, big, ctx = collections.Counter(), collections.Counter(), collections.Counter()
        for i in docs:
            for a, b in itertools.pairwise(["<s>", *toks[i]]):
                uni[b] += 1
                big[a, b] += 1
                ctx[a] += 1
        p = lambda b: (uni[b] + 0.5) / (sum(uni.values()) + 0.5 * v)
        each = [-np.log((big[a, b] + lm_scoring.MU * p(b)) / (ctx[a] + lm_scoring.MU)) for a, b in itertools.pairwise(["<s>", *tokens])]
        return float(np.mean(each)) if each else 0.0

    for i in texts:
        assert got[i].ce_target == pytest.approx(loss([1], toks[i]))
        assert got[i].ce_background == pytest.approx(loss(list(texts), toks[i]))
        assert got[i].score == pytest.approx(got[i].ce_target - got[i].ce_background)


def plain_sentences(text):
    """Words between full stops and line ends, at most MAX_SENTENCE together, with their places."""
    out, now = [], []
    for m in re.finditer(r"[^\W_]+|[.!?\n]", text):
        if m[0] in ".!?\n" or len(now) == toxicity.MAX_SENTENCE:
            out, now = out + [now] * bool(now), []
        if m[0] not in ".!?\n":
            now.append(m)
    return [(s[0].start(), s[-1].end(), [w[0].lower() for w in s]) for s in out + [now] * bool(now)]


def test_toxicity_scores_against_a_plain_noisy_or(spark):
    r = random.Random(4)
    words_, weights = ["vile", "nast*", "kind", "abcd"], np.array([3.0, 2.0, -1.5, 0.4, -2.0])
    m = toxicity.Model(words_, weights, (0.02, 0.1))
    vocab = ["Vile", "nasty", "nastiest", "KIND", "abcd", "abcdefgh", "other", "words", "ünd", ".", "!", "\n", "?", "x_y"]
    items = [" ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 5, 30, 300]))) for _ in range(60)] + ["vile " * 100, "...", None]
    df = spark.createDataFrame(list(enumerate(items)), "doc_id long, text string")
    got = {x.doc_id: x for x in toxicity.score(df, m).collect()}
    of = dict(zip(words_, weights[:-1].tolist(), strict=True))
    for i, text in enumerate(items):
        each = []
        for start, end, ws in plain_sentences(text or ""):
            own = [of[f] for w in ws for f in [w, *(w[:k] + "*" for k in (4, 5, 6, 7) if len(w) > k)] if f in of]
            each.append((start, end, min(1 / (1 + np.exp(-sum(own) - weights[-1])), 1 - 1e-12) if own else 0.0))
        clear = 1.0
        for _, _, p in each:
            clear *= 1 - p
        worst = max((p for *_, p in each), default=0.0)
        rest = -np.log(clear) + np.log(1 - worst) - 0.02 * len(each) - 0.1 * toxicity.LEAK_DEVIATIONS * len(each) ** 0.5
        assert got[i].n_sentences == len(each)
        assert got[i].score == pytest.approx(1 - (1 - worst) * np.exp(-max(rest, 0)), abs=1e-9)
        want = [x for x in each if x[2] >= toxicity.OFFENDING]
        assert [(s.start, s.end) for s in got[i].offending] == [x[:2] for x in want]
        assert [s.score for s in got[i].offending] == pytest.approx([x[2] for x in want])
    p, owner = np.array([0.5, 0.2, 0.9]), np.array([0, 0, 2])
    assert toxicity.noisy_or(p, owner, 3) == pytest.approx([0.6, 0.0, 0.9])


def test_toxicity_gradient_is_that_of_the_likelihood():
    r = np.random.default_rng(8)
    sent = np.sort(r.integers(0, 40, 200))
    feat, owner, y = r.integers(0, 6, 200), np.sort(r.integers(0, 12, 40)), r.integers(0, 2, 12)
    w = r.normal(size=7) * 0.5

    def likelihood(w):
        p = 1 / (1 + np.exp(-(np.bincount(sent, weights=w[feat], minlength=40) + w[-1])))
        doc = np.clip(toxicity.noisy_or(p, owner, 12), 1e-9, 1 - 1e-9)
        return np.mean(np.where(y == 1, np.log(doc), np.log(1 - doc)))

    got = toxicity.gradient(w, feat, sent, owner, y)
    for k in range(7):
        up, down = (w + s * 1e-5 * (np.arange(7) == k) for s in (1, -1))
        assert got[k] == pytest.approx((likelihood(up) - likelihood(down)) / 2e-5, abs=1e-5)


def test_toxicity_learns_from_bags_and_locates(spark):
    r = random.Random(9)
    rows = []
    for i in range(300):
        sents = [words(r, 8) for _ in range(6)]
        if i % 3 == 0:
            sents[r.randrange(6)] = "ababab you vilething cdcdcd"
        rows.append((i, ". ".join(sents)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    m = toxicity.train(df, labels)
    got = {x.doc_id: x for x in toxicity.score(df, m).collect()}
    assert sum((got[i].score >= 0.5) == (i % 3 == 0) for i in range(200, 300)) > 95
    assert all("vilething" in rows[i][1][s.start : s.end] for i in range(200, 300) for s in got[i].offending)
    assert sum(len(got[i].offending) for i in range(0, 300, 3)) >= 95
    long = spark.createDataFrame([(1, ". ".join(t for i, t in rows if i % 3) * 20)], "doc_id long, text string")
    assert toxicity.score(long, m).first().score < 0.5


def test_toxicity_learns_from_bounded_rows(spark):
    """One id repeated often, with one row a class asked for."""
    df = spark.createDataFrame([(1, f"text {i}") for i in range(2000)] + [(2, "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit
    try:
        toxicity.fit = lambda rows: seen.append(rows.count()) or fit(rows)
        toxicity.train(df, labels, per_class=1)
    finally:
        toxicity.fit = fit
    assert seen == [2]


def test_pipeline_runs_and_keeps_clean_documents(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = corpus_pipeline.run(spark, small)
    assert 0.6 * docs.count() < plan.count() <= docs.count()
    assert plan.select("doc_id").distinct().count() == plan.count()
