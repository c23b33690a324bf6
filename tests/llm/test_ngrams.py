"""Decontamination, importance resampling and collocations against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from tables import edge, edge_labels  # noqa: F401  isort: skip

from ontime.llm import collocations, common, decontaminate, resample

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").encode().translate(common.LOWER))


def random_texts(seed, n, size=120, vocabulary=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeFGHéß7") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    seps = [" ", "  ", ", ", ".\n", "\t", "-", "\x00", " ", "!? "]
    return ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, size))) for _ in range(n)]


# --- decontamination -----------------------------------------------------------------


def contaminated_by_hand(docs, items, n):
    windows = collections.defaultdict(set)
    for item, text in items:
        ws = words_of(text)
        size = min(n, len(ws))
        for i in range(len(ws) - size + 1 if size else 0):
            windows[tuple(ws[i:i + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        ws, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(ws) - size + 1):
                if tuple(ws[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(ws[i:i + size])]
        found = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(ws), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def planted(seed):
    docs, items = random_texts(seed, 60), random_texts(seed + 1, 25, 60, 400)
    rng = random.Random(seed)
    for k in range(30):
        ws = re.split(r"(\W+)", rng.choice(items))
        at = 2 * rng.randint(0, max(0, len(ws) // 2 - 12))
        docs[k] += " " + "".join(c.upper() if c.isascii() else c for c in "".join(ws[at:at + 2 * rng.randint(8, 30)]))
    docs += ["", None, " \n.,", docs[3], "ab " * 50]
    items += ["", None, "ab", docs[0][:40], items[2]]
    return list(enumerate(docs)) + [(3, docs[3])], [*enumerate(items), (None, items[5])]


@pytest.mark.parametrize("slice_bytes,n", [(1 << 20, 10), (1500, 4)])
def test_contamination_matches_brute_force(spark, slice_bytes, n):
    docs, items = planted(n)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(frame, bench, n=n, slice_bytes=slice_bytes).collect()
    expected = contaminated_by_hand(docs, items, n)
    assert sum(e[5] for e in expected) > 20
    assert sorted((tuple(r)[:6] for r in rows), key=str) == expected
    for r in rows:
        assert sum(s.end_word - s.first_word for s in r.spans) == r.n_hit
        assert all(a.end_word < b.first_word for a, b in zip(r.spans, r.spans[1:]))


def test_decontaminate_removes_spans_or_documents(spark):
    docs, items = planted(7)
    frame = spark.createDataFrame([(d, t, "k", d) for d, t in docs], "doc_id long, text string, key string, spans long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated_by_hand(docs, items, 10)
    left = decontaminate.decontaminate(frame, bench, remove="documents")
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(f[0] for f in found if not f[5])
    cut = decontaminate.decontaminate(frame, bench).collect()
    assert len(cut) == len(docs)
    by_id = {f[0]: f for f in found}
    for r in cut:
        assert r.key == "k" and r.spans == r.doc_id
        assert len(words_of(r.text)) >= by_id[r.doc_id][1] - by_id[r.doc_id][2] - 2  # neighbours may grow together
        if not by_id[r.doc_id][5]:
            assert r.text == dict(docs)[r.doc_id]
    assert dict((r.doc_id, r.text) for r in cut)[64] == " "  # "ab " * 50 is one span


def test_long_text_is_cut_into_pieces_at_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 7)
    for text in random_texts(3, 40) + ["x" * 100, " " * 30, "ab cdefghijklmnopqrstuvwxyz ab"]:
        raw = text.encode()
        assert [w for p in decontaminate.pieces(raw) for w in p.split()] == words_of(text)
        first, end = decontaminate.word_places(raw)
        assert [raw[a:b].translate(common.LOWER) for a, b in zip(first, end)] == words_of(text)


# --- importance resampling -----------------------------------------------------------


def resampled_by_hand(docs, target, lo, hi, buckets, percent, least):
    def hashed(text):
        ws = words_of(text)
        return [zlib.crc32(b" ".join(ws[i:i + n])) % buckets for n in range(lo, hi + 1) for i in range(len(ws) - n + 1)]

    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(hashed(text))
    for text in target:
        t.update(hashed(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for doc, text in docs:
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in hashed(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(hashed(text)), weight, score, None, len(words_of(text))])
    drawn = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(drawn[:len(drawn) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("lo,hi,buckets,percent", [(1, 1, 10_000, 10), (1, 3, 70_000, 35)])
def test_resample_matches_brute_force(spark, lo, hi, buckets, percent):
    texts = random_texts(11, 150, 60)
    docs = [*enumerate(texts), (3, texts[3]), (None, texts[9]), (901, ""), (902, None), (903, "a " * 19), (904, "a " * 20)]
    target = random_texts(11, 20, 90, 30)
    out = resample.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame([(t,) for t in target], "text string"), lo=lo, hi=hi, buckets=buckets, percent=percent)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == resampled_by_hand(docs, target, lo, hi, buckets, percent, 20)
    assert sum(r[4] is not None for r in got) > 5


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(random_texts(5, 80, 90))], "doc_id long, text string, rank long")
    target = spark.createDataFrame([("ab cd",)], "text string")
    drawn = resample.drawn_documents(docs, target, percent=50)
    assert drawn.columns == docs.columns
    ids = {r.doc_id for r in resample.resample(docs, target, percent=50).filter("rank is not null").collect()}
    assert {r.doc_id for r in drawn.collect()} == ids and ids


# --- collocations --------------------------------------------------------------------


def phrases_by_hand(rows, shortest, longest, least, top, cover):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = (text or "").encode().translate(common.LOWER)
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, longest + 1):
                f.update((lang, tuple(ws[i:i + m])) for i in range(len(ws) - m + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) >= shortest and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if any(x[0] == lang and len(x[1]) > len(p) and 100 * b >= cover * a
               and any(x[1][i:i + len(p)] == p for i in range(len(x[1]) - len(p) + 1)) for x, b in candidates.items()):
            continue
        score, k = min((10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, b" ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r + 1, phrase.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for r, (s, a, phrase, left, right) in enumerate(sorted(found)[:top]))


def phrase_rows():
    rng = random.Random(4)
    words = ["the", "New", "York", "city", "été", "a.b", "x\x00y", "of", "in", "is"]
    rows = []
    for k in range(120):
        text = "".join(rng.choice(words[:rng.randint(2, 10)]) + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ". ", " "])
                       for _ in range(rng.randint(0, 80)))
        rows.append((rng.choice(["en", "de", None, "und"]), text + rng.choice(["", " New York city is"])))
    return rows + [("en", None), ("en", ""), ("fr", "only once"), ("en", rows[0][1]), ("en", "of " * 300)]


@pytest.mark.parametrize("longest,burst,limit,piece", [(3, 4_096, 10 ** 6, 1 << 20), (3, 4, 60, 64), (2, 3, 20, 40)])
def test_collocations_match_brute_force(spark, monkeypatch, longest, burst, limit, piece):
    rows = phrase_rows()
    expected = phrases_by_hand(rows, 2, longest, 10, 12, 50)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    count_phrases = collocations.count_phrases

    def counted(*settings):
        counts = count_phrases(*settings)

        def small_parts(batches):
            collocations.BURST, collocations.SLICE, collocations.VOCABULARY = burst, piece, 20 * burst
            yield from counts(batches)
        return small_parts

    monkeypatch.setattr(collocations, "count_phrases", counted)
    out = collocations.collocations(frame, longest=longest, top=12, limit=limit)
    assert len(expected) > 20
    assert sorted(tuple(r) for r in out.collect()) == expected


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    a, left, right = 3 * 10 ** 12 + 7, 4 * 10 ** 12 + 1, 5 * 10 ** 12 + 3
    counts = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right), ("en", "", 0, 10 ** 13)],
                                   "lang string, phrase string, n_words int, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: counts)
    row = collocations.collocations(spark.createDataFrame([("en", "x")], "lang string, text string")).first()
    assert tuple(row) == ("en", 1, "x y", a, left, right, 10 ** 13, 10 ** 6 * a * a // (left * right))


# --- defined cases -------------------------------------------------------------------


def test_edge_rows_and_empty_tables(spark, edge):
    bench = spark.createDataFrame([(1, "lazy dog"), (2, None)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.contamination(edge, bench).collect()}
    assert rows[1].n_hit == rows[2].n_hit == 2 and rows[1].n_words == 10 and not rows[7].contaminated and rows[4].n_words == 0
    assert decontaminate.contamination(edge, bench.limit(0)).filter("contaminated").count() == 0
    drawn = {r.doc_id: r for r in resample.resample(edge, bench, percent=100).collect()}
    assert drawn[7]["rank"] == 1 and drawn[7].n_features == 40_000 and drawn[3].weight == 0 and drawn[1]["rank"] is None
    assert {r.phrase: r.a for r in collocations.collocations(edge, cover_percent=101).collect()} == {
        "long long": 39_999, "long long long": 39_998}
    for out in (decontaminate.contamination(edge.limit(0), bench), resample.resample(edge.limit(0), bench),
                resample.resample(edge.limit(0), bench.limit(0)), collocations.collocations(edge.limit(0)),
                decontaminate.decontaminate(edge.limit(0), bench)):
        assert out.collect() == []
