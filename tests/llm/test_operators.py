"""Operators against brute-force versions on small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tables import small, small_labels  # noqa: F401  isort: skip

from ontime.llm import byte_bpe, common, hmm_lm, jaccard_join, license_scan, mixing, pii_crf, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string"


def copies(seed: int, n: int) -> list[tuple[int, str]]:
    """Random texts with near copies, shared passages, repeats and copies."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts: list[str] = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35 or not texts:
            body = [rng.choice(words) for _ in range(rng.randint(0, 120))]
            if rng.random() < 0.4:
                body.insert(rng.randint(0, len(body)), passage)
            texts.append(" ".join(body))
        elif kind < 0.85:
            body = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                if body:
                    body[rng.randrange(len(body))] = rng.choice(words)
            texts.append(" ".join(body))
        elif kind < 0.93:
            texts.append(rng.choice(texts))
        else:
            texts.append((rng.choice(words) + " ") * rng.randint(1, 80))
    return list(enumerate(texts))


def sets_of(text: str) -> frozenset:
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().translate(common.LOWER))
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def components_of(rows: list[tuple[int, str]]) -> dict[int, tuple[int, int]]:
    sets = {d: sets_of(t) for d, t in rows}
    home = {d: d for d in sets}

    def find(x: int) -> int:
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                home[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("seed,pivots", [(1, True), (2, True), (3, False)])
def test_jaccard_join(spark, monkeypatch, seed, pivots):
    if not pivots:  # no links from the grouping step: the matrix must find all of them
        monkeypatch.setattr(jaccard_join, "group_links", lambda sets: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", 3)
    rows = copies(seed, 260)
    out = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    expected = components_of(rows)
    assert out == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 60


def substrings_removed(rows: list[tuple[int, str]]) -> dict[int, tuple]:
    first, out = set(), {}
    for doc, text in sorted(rows):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in first:
                gone[i:i + 100] = b"\1" * 100
            first.add(raw[i:i + 100])
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc] = (len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("seed,limit", [(4, 12_000), (5, 40)])
def test_suffix_dedup(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(suffix_dedup, "COLLECTION", limit)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    rows = copies(seed, 160) + [(900, "ab" * 400), (901, "q" * 500), (902, ""), (903, "abc" * 50)]
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert out == substrings_removed(rows)


def test_collection_order_groups_equal_windows():
    rng = random.Random(6)
    for _ in range(40):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(100, 168))) for _ in range(3)]
        strings = [(x[rng.randint(0, len(x) - 100):] + b"ba" * rng.randint(0, 9))[:168] for x in rng.choices(base, k=6)]
        groups = collections.defaultdict(set)
        for s, at, g in zip(*(x.tolist() for x in suffix_dedup.collection_order(strings))):
            groups[g].add((s, at))
        expected = collections.defaultdict(set)
        for s, text in enumerate(strings):
            for at in range(len(text) - 99):
                expected[text[at:at + 100]].add((s, at))
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_bpe_equals_the_library_and_decodes_back(spark, small):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    odd = ["", "日本語 \U0001f600‍  x", "aaaa" * 50, "<|endoftext|>", "don't   stop\n\n\n", "́\u0085  b", "1234567890" * 9]
    rows = [(i, t) for i, t in enumerate(odd)] + [(100 + r.doc_id, r.text) for r in small.select("doc_id", "text").limit(60).collect()]
    out = byte_bpe.byte_bpe(spark.createDataFrame(rows, SCHEMA), path, public_tokenizers.PATTERN, keep_ids=True).collect()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = dict(rows)
    for r in out:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_hmm_base_score_and_exact_likelihood(spark, small, monkeypatch):
    out = {r.doc_id: r for r in hmm_lm.hmm_lm(small).collect()}
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    words = {d: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(common.LOWER)) for d, t in texts.items()}
    train = {d for d in texts if zlib.crc32(str(d).encode()) % 5 != 1}
    count = collections.Counter(w for d in train for w in [*words[d], None])
    total, distinct = sum(count.values()), len(count)
    gain = 0.0
    for d, r in out.items():
        tokens = [*words[d], None]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d not in train, len(tokens), sum(count[w] > 0 for w in tokens), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        gain += (r.score - r.base_score) * r.held_out
    assert gain > 0  # held-out texts are likelier under the model than under the base

    model = hmm_lm.Hmm.initial()
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 5])
    symbols = rng.integers(0, hmm_lm.SYMBOLS, 9)
    found = np.empty(3)
    for docs, major, running in model.layout(symbols, lengths):
        _, scale, _ = model.forward(major, running)
        found[docs] = np.bincount(common.ragged(running)[1], weights=np.log10(scale), minlength=len(docs))
    for d, part in enumerate(np.split(symbols, np.cumsum(lengths)[:-1])):
        paths = model.start * model.emit[part[0]]
        for x in part[1:]:
            paths = paths @ model.move * model.emit[x]
        assert found[d] == pytest.approx(math.log10(paths.sum()))


def test_training_raises_the_likelihood(spark, small):
    rows = hmm_lm.sequences(small).collect()
    model, before = hmm_lm.Hmm.initial(), -np.inf
    for _ in range(3):
        total, likelihood = 0, 0.0
        for r in rows:
            for _, major, running in model.layout(np.frombuffer(r.symbols, np.int16), np.array(r.lengths) + 1):
                total = total + model.expected(major, running)
                likelihood += np.log(model.forward(major, running)[1]).sum()
        assert likelihood > before
        before = likelihood
        start, move, emit = total[0], total[1:5] + 1e-9, total[5:] + 1e-9
        model = hmm_lm.Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_license_templates():
    scanner = license_scan.Scanner({"T": "[[ this {{w:2}} is ]] granted (( free || paid )) use", "U": "no {{x:1}} limit"})

    def runs(text: str) -> list:
        return scanner.scan(text.encode().translate(license_scan.WORD_BYTES).split())[1]

    assert runs("This small work is granted FREE use") == [("T", 0, 7), ("T", 4, 7)]
    assert runs("granted, paid use") == [("T", 0, 3)] and runs("granted use") == []
    assert runs("no limit no big limit no very big limit") == [("U", 0, 2), ("U", 2, 5)]
    with pytest.raises(ValueError):
        license_scan.Automaton("a [[ b")


def test_license_counts(spark):
    rows = [(1, "MIT License. Released under the MIT License"), (2, "general public license; general-public license"), (3, "mit"),
            (4, None)]
    out = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (out[1].n_words, out[1].n_base, out[1].first_word, out[1].last_word, out[1].base_labels) == (7, 2, 0, 5, "mit")
    assert out[1].labels == "MIT,mit" and out[1].score == 1.0
    assert (out[2].n_base, out[2].first_word, out[2].last_word, out[2].base_labels, out[2].score) == (2, 0, 3, "gpl", 0.5)
    assert (out[3].n_base, out[3].first_word, out[3].labels, out[3].score) == (0, None, "", 0.0) and out[4].n_words == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
OTHERS = {"ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text: str) -> str:
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    for k, (kind, pattern) in enumerate(OTHERS.items(), 1):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")) or kind == "phone" and 10 <= len(digits) <= 15
                    or kind == "card" and 14 <= len(digits) <= 19 and pii_crf.luhn(digits)):
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii_crf.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_pii_base_spans_equal_the_patterns(small):
    rng = random.Random(9)
    alphabet = "ab.@@-+0123459 ()é_%"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += [r.text or "" for r in small.collect()]
    texts += ["x@y.z@a.b", "4111 1111 1111 1111 and 1.2.3.4.5.6.7.8", "+1 (212) 555-0123", "a@b..c", "1.2.3.999 1.2.3.4"]
    for text in texts:
        assert pii_crf.written(pii_crf.base_spans(text)) == plain_spans(text), text


def test_pii_field_adds_spans_and_keeps_base_ones(spark):
    rows = [(1, "Call 415-555-0142 or mail jo@x.example.org now"), (2, "version 2.0 of 14 items on 2021-03-04"), (3, None)]
    out = {r.doc_id: r for r in pii_crf.pii_crf(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[1].spans == "phone:5:17,email:26:42" and (out[1].n_email, out[1].n_phone, out[1].n_added) == (1, 0, 1)
    assert out[2].spans == "" and out[3].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_viterbi_equals_enumeration():
    field = pii_crf.Field().train(pii_crf.LABELLED, rounds=10)
    rng = np.random.default_rng(3)
    runs = [rng.normal(size=(n, 5)) * 3 for n in (1, 3, 2, 3)]
    for scores, path in zip(runs, field.decode(runs)):
        def value(labels):
            steps = (0, *labels, 0)
            return sum(field.move[a, b] for a, b in zip(steps, steps[1:])) + sum(s[k] for s, k in zip(scores, labels))
        best = max(np.ndindex(*(5,) * len(scores)), key=value)
        assert value(tuple(path)) == pytest.approx(value(best))


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioklmnst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = ["idiotic", "scum", "worthless", "vekuna"]
    rows, marks = [], []
    for d in range(1500):
        toxic = d % 8 == 0
        body = [rng.choice(words) for _ in range(40)]
        for _ in range(rng.randint(2, 4) if toxic else 0):
            body.insert(rng.randrange(40), rng.choice(bad))
        rows.append((d, " ".join(body)))
        marks.append((d, 1, int(toxic)))
    out = toxicity.toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert held and all(r.predicted == (r.doc_id % 8 == 0) for r in held)
    assert all((r.score >= 0.7) == bool(r.predicted) for r in out)


def test_mixing_end_to_end_reaches_the_minimum(spark, small, small_labels):
    out = mixing.mixing(small, small_labels).collect()
    p = np.array([[r.p_good, r.p_low, r.p_toxic] for r in out])
    t, rate = np.array([r.n_tokens for r in out], float), np.array([r.rate for r in out])
    assert np.allclose(p.sum(1), 1, atol=1e-6) and (rate >= 0).all()
    weights = np.array([mixing.WEIGHTS[d] for d in mixing.DOMAINS])
    target = t.sum() * weights / weights.sum()
    slope = p @ (((rate * t) @ p - target) / target) + mixing.RIDGE * (rate - 1)
    # Zero slope where a rate is free, none that pulls a rate of zero up: the only minimum.
    assert np.abs(np.where(rate > 0, slope, np.minimum(slope, 0))).max() < 1e-6
    assert np.abs((rate * t) @ p - target).max() < 0.02 * t.sum()
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in out)



def test_spans_of_windows():
    none = np.empty(0, int)
    assert all(len(x) == 0 for x in suffix_dedup.spans(none, none))
    doc, start, end = suffix_dedup.spans(np.array([2, 1, 1, 1]), np.array([0, 6, 5, 300]))
    assert list(zip(doc, start, end)) == [(1, 5, 106), (1, 300, 400), (2, 0, 100)]
