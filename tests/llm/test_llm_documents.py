"""Operators on documents: awkward inputs, and small brute-force versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlprism.llm import bagminhash, decontam, linedup, lm, mixing, quality, textio, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string, _row int, size string, band string"
LONG = " ".join(f"word{i % 977} the of number{i}" for i in range(30000))
BASE = " ".join(f"tok{i} and so" for i in range(60)) + "."
ROWS = [
    (1, None, None, None, None),
    (None, "hello world", None, "s", 1),
    (2, "", "en", "s", 0),
    (3, "   \n ", "en", None, 0),
    (4, LONG, "en", "s", 5),
    (5, BASE, "en", "t", 1),
    (5, BASE, "en", "t", 1),
    (6, BASE, "de", "t", 1),
    (7, BASE + " extra words here", "en", "t", 1),
    (8, "é ü", "fr", "s", 3),
]
ITEMS = [(1, BASE[:300]), (2, None), (3, ""), (None, "one two three four five six seven eight nine ten")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "y", 1, "z", "b") for r in ROWS], SCHEMA).repartition(3, "text").cache()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words_and_hashes():
    texts = ["a bb\tccc", "", "  x ", "né 日本 q", "a bb"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, first = textio.words(data, offsets)
    found = [data[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
    assert found == [w for t in texts for w in words(t)]
    assert list(np.diff(first)) == [len(words(t)) for t in texts]
    hashes = textio.span_hashes(data, starts, ends)
    same = {}
    for w, h in zip(found, hashes, strict=True):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)


def test_quality_base_rules(docs):
    got = sorted(map(tuple, quality.verdicts(docs, ["doc_id"]).drop("kept", "log_ppl").collect()), key=str)

    def base(i, text):
        w, t = words(text), text or ""
        seen, dup = set(), 0
        for line in t.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        runs = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        inside = {k + j for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for j in range(3)}
        return i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)

    assert got == sorted((base(r[0], r[1]) for r in ROWS), key=str)


def test_quality_counts_lines_and_repeats(spark):
    text = "a b c d\na b c d\n\n  \nx # y\n#| <\nx # y"
    row = quality.verdicts(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), ["doc_id"]).first()
    assert (row.n_dup_lines, row.n_symbols, row.n_repeat_words, row.kept) == (2, 5, 14, False)


def test_kneser_ney_sums_to_one(docs):
    model = quality.kneser_ney(quality.gram_counts(docs))
    for context in (0, 5 << 10, (27 << 10) | (1 << 5) | 2):
        grams = (np.int64(context) << 5) + np.arange(32)
        assert math.isclose((10 ** quality.log_probabilities(model, grams)).sum(), 1, rel_tol=1e-9)


def test_quality_rejects_another_kind_of_text(spark):
    draw = np.random.RandomState(2)
    known = ["".join(draw.choice(["ba", "ne", "sto", "ri", "lum", "ta"], draw.randint(1, 4))) for _ in range(300)]
    plain = [(i, " ".join(draw.choice(known, 400)), "en") for i in range(1, 60)]
    odd = (0, " ".join("".join(chr(c) for c in draw.randint(97, 123, 7)) for _ in range(400)), "en")
    rows = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame([odd, *plain], "doc_id long, text string, lang string"), ["doc_id"]).filter("not base_failed").collect()}
    assert not rows[0] and all(v for k, v in rows.items() if k)


def test_quality_keeps_columns(docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} <= {4, 5, 6, 7}


def symbols_of(texts):
    """The prefix code of the texts' code points as a dictionary."""
    counts = Counter("".join(texts))
    points, lengths, rows = quality.prefix_code(np.array([ord(c) for c in counts]), np.array(list(counts.values())))
    return {chr(p): tuple(int(s) for s in r[:n]) for p, n, r in zip(points, lengths, rows, strict=True)}


@pytest.mark.parametrize("kinds", [1, 2, 31, 32, 61, 62, 700])
def test_prefix_code_loses_nothing(kinds):
    """No word begins another, symbol 0 is left free, and code points that occur more often have no longer words."""
    counts = np.array([1 + 3 * (k % 7) ** 4 for k in range(kinds)])
    points, lengths, rows = quality.prefix_code(np.arange(kinds)[::-1] + 40, counts[::-1])
    words = [tuple(r[:n]) for n, r in zip(lengths, rows, strict=True)]
    assert list(points) == list(range(40, 40 + kinds)) and len(set(words)) == kinds
    assert all(w and min(w) > 0 and max(w) < 32 for w in words)
    assert not any(w[:k] in set(words) for w in words for k in range(1, len(w)))
    assert all(lengths[a] <= lengths[b] for a in range(kinds) for b in range(kinds) if counts[a] > counts[b])


SCRIPTS = ["", "a", "Ab", "é", "Привет, мир! Как дела?", "данные и ещё данные", "你好世界 你好", "AB ab 12 34 \U0001f600 a\nb", "the the then", "x" * 30]


def test_grams_hold_every_symbol_of_every_text(spark):
    raw = [t.encode() for t in SCRIPTS]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    points, begin = quality.code_points(data, offsets)
    assert ["".join(map(chr, points[a:b])) for a, b in zip(begin[:-1], begin[1:], strict=True)] == SCRIPTS
    code = symbols_of(SCRIPTS)
    rows = [(t, "en") for t in [*SCRIPTS, None]]
    got = {r.gram: r.c for r in quality.gram_counts(spark.createDataFrame(rows, "text string, lang string")).collect()}
    want = Counter()
    for t in SCRIPTS:
        stream = [0] * (quality.ORDER - 1) + [s for c in t for s in code[c]]
        for k in range(len(stream) - quality.ORDER + 1):
            gram = 0
            for s in stream[k : k + quality.ORDER]:
                gram = gram << quality.BITS | s
            want[gram] += 1
    assert got == want


def brute_force_perplexities(texts):
    code, order = symbols_of(texts), quality.ORDER
    streams = [[0] * (order - 1) + [s for c in t for s in code[c]] for t in texts]
    tables = {order: Counter(tuple(s[k : k + order]) for s in streams for k in range(len(s) - order + 1))}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    after, discounts = {}, {}
    for n, table in tables.items():
        n1, n2, n3, n4 = (max(1, sum(c == k for c in table.values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        discounts[n] = [0] + [min(max(x, 0.05), k) for k, x in ((0.95, 1 - 2 * y * n2 / n1), (1.9, 2 - 3 * y * n3 / n2), (2.8, 3 - 4 * y * n4 / n3))]
        for g, c in table.items():
            after.setdefault((n, g[:-1]), []).append(c)

    def p(g):
        if not g:
            return 1 / 32
        seen, d = after.get((len(g), g[:-1])), discounts[len(g)]
        if not seen:
            return p(g[1:])
        c = tables[len(g)][g]
        return (c - d[min(c, 3)]) / sum(seen) + sum(d[min(x, 3)] for x in seen) / sum(seen) * p(g[1:])

    grams = [[tuple(s[k : k + order]) for k in range(len(s) - order + 1)] for s in streams]
    return [-sum(math.log10(p(g)) for g in own) / len(t) if t else None for t, own in zip(texts, grams, strict=True)]


def test_perplexity_against_brute_force(spark, monkeypatch):
    """Also where tasks give counts on early, and hold one of many parts of the model at a time."""
    texts = [*SCRIPTS, *[" ".join(words(LONG)[k : k + 40]) for k in range(0, 400, 40)]]
    rows = [(k, t, "en") for k, t in enumerate(texts)] + [(len(texts), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    want = dict(enumerate([*brute_force_perplexities(texts), None]))
    for small in (False, True):
        if small:
            for name, n in (("GATHERED", 100), ("HELD", 50), ("PART", 64), ("BLOCK", 300)):
                monkeypatch.setattr(quality, name, n)
            monkeypatch.setattr(textio, "BATCH_ROWS", 2)
            usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
            parts = quality.model_parts(quality.gram_counts(docs))
            assert len(parts) > 5 and all(a < b for a, b in parts) and all(x[1] <= y[0] for x, y in zip(parts, parts[1:], strict=False))
        got = {r.doc_id: r.log_ppl for r in quality.verdicts(docs, ["doc_id"]).collect()}
        assert got.keys() == want.keys()
        for k, x in want.items():
            assert (got[k] is None) if x is None else math.isclose(got[k], x, rel_tol=1e-5), (small, k)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуф", "αβγδεζηθικλμνξοπρστυ", "ابتثجحخدذرزسشصضطظعغف"])
def test_quality_rejects_other_letters_of_the_same_length(spark, letters):
    """Letters exchanged for others of the same script, case and byte length."""
    draw = np.random.RandomState(4)
    syllables = [letters[a] + letters[b] for a, b in zip(range(0, 10), range(10, 20), strict=True)]
    known = ["".join(draw.choice(syllables, draw.randint(1, 4))) for _ in range(200)]
    plain = [(i, " ".join(draw.choice(known, 400)), "xx") for i in range(1, 60)]
    odd = "".join(c if c == " " else letters[draw.randint(20)] for c in " ".join(draw.choice(known, 400)))
    docs = spark.createDataFrame([(0, odd, "xx"), *plain], "doc_id long, text string, lang string")
    rows = {r.doc_id: r.kept for r in quality.verdicts(docs, ["doc_id"]).filter("not base_failed").collect()}
    assert not rows[0] and all(v for k, v in rows.items() if k) and len(rows) == 60


def passages(n, seed):
    draw = np.random.RandomState(seed)
    return [" ".join("w" + str(draw.randint(10**6)) for _ in range(12)) + "." for _ in range(n)]


def test_line_dedup_removes_shared_passages(spark):
    shared = "\n".join(passages(7, 1))
    texts = {i: "\n".join([*passages(4, 100 + i), shared, *passages(3, 200 + i)]) for i in range(6)}
    texts[9] = texts[3]
    texts[10] = "Title here\n" + "\n".join(passages(5, 300))
    texts[11] = "Title here\n" + "\n".join(passages(5, 301))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in linedup.dedup_lines(rows.repartition(4)).collect()}
    assert got[0].text == texts[0]
    for i in range(1, 6):
        assert shared.split("\n")[3] not in got[i].text
        assert set(texts[i].split("\n")) - set(shared.split("\n")) <= set(got[i].text.split("\n"))
    assert got[9].text == "" and got[9].n_removed == 14
    assert got[10].text == texts[10] and got[11].text == texts[11]
    kept = {r.doc_id for r in linedup.keep_texts(rows).collect()}
    assert kept == set(texts) - {9}


def lines(draw, least):
    """Lines of 1 to 24 random words, of ``least`` words in all or more."""
    out, n = [], 0
    while n < least:
        k = draw.randint(1, 25)
        out.append(" ".join("w" + str(draw.randint(10**6)) for _ in range(k)))
        n += k
    return out


def test_line_chunks_do_not_shift():
    draw = np.random.RandomState(3)
    for _ in range(300):
        passage, found = lines(draw, linedup.WINDOW + 2 * linedup.LEAST_WORDS), []
        for _ in range(2):
            before = lines(draw, draw.randint(0, 90))
            data, offsets = textio.texts(pa.array(["\n".join([*before, *passage, *lines(draw, draw.randint(0, 90))])]))
            _, _, words, hashes, first = linedup.units(data, offsets)
            key, a, b = linedup.chunks(words, hashes, first)
            assert all(words[x:y].sum() >= linedup.LEAST_WORDS > words[x : y - 1].sum() for x, y in zip(a, b, strict=True))
            inside = (a >= len(before)) & (b <= len(before) + len(passage))
            found.append(set(key[inside].tolist()))
        assert found[0] & found[1]


def test_line_dedup_cuts_passages_out_exactly(spark):
    draw = np.random.RandomState(8)
    shared = [lines(draw, 63) for _ in range(6)]
    shared.append(["five short words a line" + str(k) for k in range(14)])
    texts, want, seen = {}, {}, set()
    for i in range(40):
        all_, left = [], []
        for k in draw.permutation(len(shared))[:3]:
            own = lines(draw, 40)
            all_ += own + shared[k]
            left += own + (shared[k] if k not in seen else [])
            seen.add(k)
        texts[i], want[i] = "\n".join(all_), "\n".join(left)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.text for r in linedup.dedup_lines(rows).collect()}
    assert got == want


def test_line_dedup_wants_one_earlier_text(spark):
    lone = passages(8, 40)
    texts = [(k, "\n".join([*passages(3, 50 + k), lone[k], *passages(3, 70 + k)])) for k in range(8)]
    texts.append((9, "\n".join([*passages(3, 90), *lone, *passages(3, 91)])))
    got = linedup.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {(r.doc_id, r.text) for r in got.collect()} == set(texts)


def test_line_dedup_awkward(docs):
    got = linedup.keep_texts(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([1, None, 2, 3, 4, 5, 5, 7, 8], key=str)


def test_near_duplicates_brute_force(spark):
    draw = np.random.RandomState(3)
    texts = []
    for g in range(12):
        w = [f"g{g}x{draw.randint(400)}" for _ in range(80)]
        for _ in range(8):
            v = list(w)
            for _ in range(draw.randint(0, 5)):
                v[draw.randint(80)] = f"e{draw.randint(10**6)}"
            texts.append(" ".join(v))
    texts += ["a b", "a b", "a  b", "", "", "x " * 50, "x " * 55, "x " * 90]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in bagminhash.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}

    def bag(t):
        w = words(t)
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])

    bags, least = [bag(t) for t in texts], list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in enumerate(bags):
        for j in range(i):
            shared = sum((a & bags[j]).values())
            if a and 5 * shared >= 4 * (a.total() + bags[j].total() - shared):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    assert got == {i: root(i) for i in range(len(texts))}


def test_signatures_estimate_weighted_similarity():
    element = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = np.full(40, 3), np.full(40, 3)
    b[:10] = 6
    text = np.repeat([0, 1], 40)
    s = bagminhash.signatures(text, np.tile(element, 2), np.concatenate([a, b]), 2)
    agreed = (s[0] == s[1]).mean()
    assert abs(agreed - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.12
    alone = bagminhash.signatures(np.zeros(40, int), element, a, 1)
    assert (alone[0] == s[0]).all()


def test_near_duplicates_awkward(docs):
    got = {(r.doc_id, r.class_id) for r in bagminhash.classes(docs).collect()}
    assert got == {(1, 1), (None, None), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 5), (8, 8)}
    assert bagminhash.keep_one(docs).columns == docs.columns


def test_decontamination(spark, docs):
    item = "Once Bob ran 12 km to see Alice and then Bob ate 3 apples in the old town hall today."
    texts = [
        (1, "Before it. " + item + " After it."),
        (2, item.replace("Bob", "Tom").replace("12 km", "15 miles").replace("Alice", "Mary")),
        (3, "Once Tom ran 15 miles to see Mary and then Ann ate 3 apples in the old town hall today."),
        (4, "ONCE, bob ran nowhere at all and the old town hall was shut."),
        (5, None),
    ]
    found = decontam.leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 9), (2, 9)}
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontam.without_leaks(docs, items)
    assert clean.columns == docs.columns
    assert decontam.leaks(docs.limit(0), items).isEmpty() and decontam.leaks(docs, items.limit(0)).isEmpty()


def test_decontamination_judges_each_occurrence(spark):
    item = "Once Bob ran 12 km to see Alice and then Bob ate 3 apples in the old town hall today."
    item += " All of the people there had been waiting for a long time, and so Bob said that it was over at last and went home."
    other = item.replace("Bob ate", "Tom ate").replace("12 km", "15 miles")
    longer = item.replace("then Bob", "then very slowly Bob")
    filler = "nothing of this kind was ever said in here. " * 5
    texts = [
        (1, f"{item} {other}"),
        (2, f"{other} {item}"),
        (3, f"{item} {filler} Once Ann ran 99 km to see Kim and then went home."),
        (4, f"{other} {longer} {other}"),
        (5, f"{other} {filler} {other}"),
        (6, item.replace("and then", f"and {filler} then")),
    ]
    rows, items = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")
    found = decontam.leaks(rows, items).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 3, 4, 6]
    assert {r.doc_id for r in decontam.without_leaks(rows, items).collect()} == {5}


def test_decontamination_finds_exact_copies(spark):
    items = [
        (1, "What is 12 + 45 - 7 * 3?"),
        (2, "Ann, Bob, Kim, Lou, Max, Ned, Pia, Roy or Sue: 1910, 1920, 1930 or 1940?"),
        (3, "小明有三个苹果，又买了五个，请问他一共有几个苹果？"),
        (4, "แมวกินปลาทุกวัน"),
        (5, "Paris"),
    ]
    texts = [
        (1, 'He asked: "What is 12 + 45 - 7 * 3?" Nobody knew.'),
        (2, "Read on. " + items[1][1] + " So it was."),
        (3, "题目如下：" + items[2][1] + "答案是八个。"),
        (4, "เมื่อวาน" + items[3][1] + "มาก"),
        (5, " paris.\n"),
        (11, "What is 12 + 45 - 7 * 4?"),
        (12, items[1][1].replace("Ned", "Tim")),
        (13, "小明有三个苹果，又买了六个，请问他一共有几个苹果？"),
        (15, "Paris is a town."),
    ]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = decontam.leaks(rows, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, k) for k in range(1, 6)}


def test_mixing(docs):
    rows = mixing.taken(docs).collect()
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(words(r[1]))
    assert sorted((r.size for r in rows)) == sorted(len(words(r[1])) for r in ROWS)
    by_target = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.target <= 3 * r.source_size
        by_target.setdefault((r.source_size, r.target), []).append(r.taken)
    for (_, target), taken in by_target.items():
        assert abs(sum(taken) - target) <= 4 * mixing.BLOCK
    assert sorted(rows, key=str) == sorted(mixing.taken(docs).collect(), key=str)
    assert mixing.taken(docs.limit(0)).isEmpty()


def test_lm_base_and_normalisation(spark, docs):
    got = lm.score(docs).collect()
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tokens = {i: [*(t or "").encode().translate(table).split(), None] for i, t, *_ in ROWS if i is not None}
    counts = Counter()
    for i, t, *_ in ROWS:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            counts.update([*(t or "").encode().translate(table).split(), None])
    n, norm = counts.total(), counts.total() + 0.1 * (len(counts) + 1)
    assert len(got) == len(ROWS)
    for r in got:
        assert r.train_tokens == n
        if r.doc_id is not None:
            own = tokens[r.doc_id]
            assert r.n_tokens == len(own) and r.n_known == sum(counts[w] > 0 for w in own)
            assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / norm) for w in own), rel_tol=1e-9)
    model, _ = lm.train(docs.select("doc_id", "text", F.lit(False).alias("held_out")))
    t = lm.Tokens(np.frombuffer(b"the of tok1", np.uint8), np.array([0, 11]))
    for at in range(4):
        f = np.repeat(t.features(at, at + 1), lm.SLOTS, axis=0)
        slots = np.arange(lm.SLOTS)
        a, b = lm._rows(f, slots)
        p = lm._softmax(model["weights"][0], a)[slots, slots // 16] * lm._softmax(model["weights"][1], b)[slots, slots % 16]
        assert math.isclose(p.sum(), 1, rel_tol=1e-5)
    for slot in np.flatnonzero(model["size"]):
        known = model["size"][slot] - lm.DISCOUNT * model["kinds"][slot]
        assert math.isclose(known / model["size"][slot] + 10 ** lm.log_in_slot(model, np.array([slot]), np.array([0]))[0], 1, rel_tol=1e-9)
    assert lm.score(docs.limit(0)).isEmpty()


def test_lm_learns_order(spark):
    texts = [(i, "alpha beta gamma delta " * (20 + i % 5)) for i in range(200)] + [(1000, "delta gamma beta alpha " * 20), (1001, "alpha beta gamma delta " * 20)]
    rows = {r.doc_id: r for r in lm.score(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert rows[1001].score > rows[1000].score + 10
    held = [r for r in rows.values() if r.held_out and r.doc_id < 1000]
    assert held and all(r.score > r.base_score for r in held)


def test_toxicity_held_out(spark):
    draw = np.random.RandomState(5)
    plain = [f"{a}{b}{c}" for a in ("mi", "ta", "lo", "ve") for b in ("ran", "sil", "dor", "kem") for c in ("a", "ing", "ed")]
    bad = ["zqvulk", "frogzak", "muxxelt"]
    texts, labels = [], []
    for i in range(500):
        w = list(draw.choice(plain, 60))
        if i % 4 == 0:
            for k in draw.randint(0, 60, 3):
                w[k] = bad[draw.randint(3)]
        texts.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    texts += [(900, None), (901, "")]
    rows = toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in rows if r.held_out and r.doc_id < 500]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows) and len(rows) == 502


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([(5, 0), (6, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, none.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), none).isEmpty()
