"""Source divergence, fill-in-middle and packing against plain versions, on odd rows, and their plans."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import divergence, infill, packing

SCHEMA = "doc_id long, text string, lang string, source string"
#: Names the operators use themselves.
CLASHING = ("of", "terms", "vector", "n", "p", "none", "part", "term_no", "total", "row", "size", "dealt", "group_no", "bins", "sequence_id", "offset", "form", "piece")


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


def _plain_audit(rows, min_df, top):
    """Everything counted in dictionaries."""
    rows = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    words, df, group = [], defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        cleaned = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or c > "\x7f" else " " for c in text)
        found = [w for w in cleaned.split(" ") if w]
        words.append(found)
        df[lang].update(set(found))
    for (_, lang, source), found in zip(rows, words, strict=True):
        group[lang, source].update(w for w in found if df[lang][w] >= min_df)
    out = set()

    def share(counts, kept):
        total = sum(counts.values())
        return {w: 1 + 10**9 * (counts[w] + 5) // (total + 5 * len(kept)) for w in kept}

    for lang, source in group:
        kept = [w for w in df[lang] if df[lang][w] >= min_df]
        own = share(group[lang, source], kept)
        whole = share(sum((c for (k, _), c in group.items() if k == lang), Counter()), kept)
        far = [(sum(abs(own[w] - p) for w, p in share(group[lang, other], kept).items()), other) for k, other in group if k == lang and other != source]
        above = [(own[w] - whole[w], w) for w in kept if group[lang, source][w] and own[w] > whole[w]]
        for part, listed in (("pair", far), ("term", above)):
            for rank, (value, item) in enumerate(sorted(listed, key=lambda x: (-x[0], x[1].encode())), 1):
                if part == "pair" or rank <= top:
                    out.add((lang, source, part, item, value, rank))
    return out


def _audit_rows(n, seed):
    rng = random.Random(seed)
    vocabulary = ["Été", "ÉTÉ", "été", "A", "a", "the", "THE", "中文", "x1y", "naïve", "zeta", "b-c"]
    rows = [(i, " ".join(rng.choices(vocabulary[: 4 + i % 9], k=rng.randint(0, 12))), rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "é", None])) for i in range(n)]
    return [*rows, (None, None, None, None), (None, None, "it", "only"), (3, "", "it", None), (3, "", "it", None), (9, "long " * 50_000, "en", "a")]


@pytest.mark.parametrize(("min_df", "top"), [(3, 50), (30, 2), (10_000, 5)])
def test_audit_agrees_with_dictionaries(spark, min_df, top):
    rows = _audit_rows(150, 3)
    out = divergence.audit(_docs(spark, rows), min_df, top).collect()
    assert {tuple(r) for r in out} == _plain_audit(rows, min_df, top)
    assert len(out) == len({tuple(r) for r in out})


def test_audit_compares_sources_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "TERMS", 3)
    rows = [(i, f"w{'abcdefg'[i % 7]} w{'abc'[i % 3]} common", "en", f"s{i % 9}") for i in range(80)]
    out = divergence.audit(_docs(spark, rows), 5).collect()
    assert {tuple(r) for r in out} == _plain_audit(rows, 5, 50)


@pytest.mark.parametrize("held", [1, 100])
def test_vector_sums_are_handed_on_in_parts(spark, held):
    rng = random.Random(8)
    rows = [(f"s{i % 7}", sorted(rng.sample(range(12), i % 5))) for i in range(200)]
    rows = [(s, at, [float(1 + k) for k in at]) for s, at in rows]
    want = Counter()
    for s, at, n in rows:
        want.update({(s, i): int(v) for i, v in zip(at, n)})
    out = divergence._group_sums(spark.createDataFrame(rows, "source string, i array<int>, v array<double>"), 12, held).collect()
    assert {(r["source"], r["term_no"]): r["n"] for r in out} == want and len(out) == len(want)


def test_audit_of_nothing(spark):
    out = divergence.audit(_docs(spark, []))
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_stay_exact_beyond_64_bits(spark):
    n, total, terms = 123_456_789_012_345, 987_654_321_098_765, 10**7
    told = spark.range(1).select(divergence.share(*(F.lit(x).cast("long") for x in (n, total, terms)))).first()[0]
    assert told == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def _plain_infill(doc_id, text):
    text = text or ""
    units = [u for u in text.split("\n")]
    units = [u + "\n" for u in units[:-1]] + ([units[-1]] if units[-1] else [])
    told = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(told[k : k + 8], 16) for k in range(0, 32, 8)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text, sha(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(units), form, len(p), len(m), out, sha(text)


def _infill_rows():
    rng = random.Random(5)
    texts = ["\n".join(rng.choices(["", "é", "a b", "中" * 40, "x" * 300, "\r"], k=rng.randint(0, 30))) for _ in range(120)]
    texts += [None, "", "\n", "\n\n", "one line", "a<P>b\nc", "<S", "<M>", "y" * 3_000_000, "line\n" * 200_000]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    return [*rows, (None, "a\nb", None, None), (None, None, None, None), (7, "other\ntext", None, None), *[(500, "same\nrow\n", None, None)] * 20]


def test_infill_agrees_with_plain_version(spark):
    rows = _infill_rows()
    want = Counter(_plain_infill(i, t) for i, t, _, _ in rows)
    docs = _docs(spark, rows)
    texts = Counter(tuple(r) for r in infill.transformed(docs, limit=64).collect())
    assert texts == Counter((*w[:6],) for w in want.elements())
    for limit in (64, infill.CHUNK):
        out = Counter(tuple(r) for r in infill.digests(docs, limit=limit).collect())
        assert out == Counter((*w[:5], hashlib.sha256(w[5].encode()).hexdigest(), w[6]) for w in want.elements())
    assert infill.digests(_docs(spark, [])).count() == 0


def test_infill_restores_on_the_same_partitions_and_spreads_equal_rows(spark):
    docs = _docs(spark, [(1, "same\nrow\n", None, None)] * 400)
    pieces = infill.assembled(docs, partitions=8)
    assert infill.restored(pieces).partitioner == pieces.partitioner
    told = infill.restored(pieces).toDebugString().decode()
    assert told.count("ShuffledRDD") + told.count("PairwiseRDD") <= 2
    sizes = pieces.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert max(sizes) < 0.5 * sum(sizes)


def test_chunks_hold_whole_units_where_they_fit():
    text = "ab\n" * 100 + "é" * 500 + "\n" + "c"
    made = list(infill.chunks(text, 64))
    assert b"".join(made).decode() == text and max(map(len, made)) <= 64
    assert all(c.endswith(b"\n") for c in made[:10])


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def _ids(texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*coder.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def _check_packing(rows, found, length):
    """Every id is in one piece, pieces are cut by the rule, sequences have no gap and are not too long."""
    by_text = Counter()
    for (doc_id, *_), ids in zip(rows, _ids([r[1] for r in rows]), strict=True):
        first = (len(ids) - 1) % length + 1
        ends = range(first, len(ids) + 1, length)
        for k, end in enumerate(ends):
            part = ids[max(0, end - length) : end]
            by_text[doc_id, k, max(0, end - length), len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == by_text
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


def test_packing_follows_the_rules(spark, tokens, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "été", "x", "12", "\n"], k=rng.randint(0, 400))), None, None) for i in range(150)]
    rows += [(None, None, None, None), (None, "", None, None), (5, "again", None, None), (5, "again", None, None), (6, "a <|endoftext|> b", None, None), (7, "word " * 40_000, None, None), (8, " " * 9_000 + "x", None, None)]
    docs = _docs(spark, rows)
    found = packing.places(docs, tokens, length=128).collect()
    lengths = np.array([r["length"] for r in found])
    assert _check_packing(rows, found, 128) <= 1.01 * packing.least_bins(lengths, 128) + 1
    monkeypatch.setattr(packing, "GROUP", 50)
    assert _check_packing(rows, packing.packed(packing.cut(docs, tokens, 128), 128, 50).collect(), 128) <= 1.1 * packing.least_bins(lengths, 128)
    assert packing.places(_docs(spark, []), tokens).count() == 0


def test_packing_keeps_ids(spark, tokens):
    out = packing.pack(_docs(spark, [(1, "some text here", None, None)]), tokens, length=2).collect()
    assert sum((r["ids"] for r in sorted(out, key=lambda r: r["piece"])), []) == _ids(["some text here"])[0]


def test_runs_end_where_pre_tokens_end(tokens):
    rng = random.Random(2)
    text = "".join(rng.choices(["a", "é", " ", "  ", "\n", "'s", "12", "中", "<|endoftext|>"], k=5000))
    parts = list(packing.runs(text, 50))
    assert "".join(parts) == text and len(parts) > 50
    assert np.concatenate([tokens.encode(p)[:-1] for p in parts]).tolist() == _ids([text])[0][:-1]


def _fewest(sizes, length):
    """Fewest sequences by trying every assignment."""
    best = len(sizes)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= length:
                bins[j] += sizes[k]
                go(k + 1, bins)
                bins[j] -= sizes[k]
        go(k + 1, [*bins, sizes[k]])

    go(0, [])
    return best


def test_least_bins_is_never_above_the_fewest():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        fewest = _fewest(sizes, 30)
        assert packing.least_bins(np.array(sizes), 30) <= fewest
        best = packing.evolve(np.array(sizes), [], 0, 0, 30)[0]
        assert fewest <= best.max() + 1 <= fewest + 1


def test_crossover_beats_best_fit_decreasing():
    """Best-fit decreasing leaves triples apart here; children that keep full sequences whole bring them together."""
    rng = random.Random(5)
    sizes = []
    for _ in range(60):
        a, b = rng.randint(260, 380), rng.randint(260, 380)
        sizes += [a, b, 1000 - a - b]
    sizes = np.array(sorted(sizes, reverse=True))
    plain = len(packing.best_fit(sizes.tolist(), list(range(len(sizes))), ([], []), 1000)[0])
    elites, found = [], plain
    for epoch in range(2):
        elites = packing.evolve(sizes, elites, 0, epoch, 1000)
        found = min(found, int(elites[0].max()) + 1)
    assert 60 <= found < plain
    loads = np.bincount(elites[0], weights=sizes)
    assert loads.max() <= 1000 and loads.sum() == sizes.sum()


def test_children_hold_every_piece_once_and_injected_sequences_whole():
    rng = np.random.default_rng(6)
    sizes = sorted(rng.integers(1, 100, 200).tolist(), reverse=True)
    one = packing.best_fit(sizes, list(range(200)), ([], []), 100)
    two = packing.best_fit(sizes, rng.permutation(200).tolist(), ([], []), 100)
    child, loads = packing.crossed(one, two, sizes, 100, rng)
    assert sorted(itertools.chain.from_iterable(child)) == list(range(200))
    assert loads == [sum(sizes[i] for i in b) for b in child] and max(loads) <= 100
    whole = {frozenset(b) for b in one[0]} & {frozenset(b) for b in child}
    assert len(whole) >= 0.4 * len(one[0])


def test_elites_move_to_the_next_island(spark):
    rows = [(1, i, 1, [5, 4], [[i, 0], [9, 9]]) for i in range(packing.ISLANDS)]
    out = {r["island"]: r["elites"] for r in packing._migrated(spark.createDataFrame(rows, packing._STATE)).collect()}
    assert out == {(i + 1) % packing.ISLANDS: [[(i + 1) % packing.ISLANDS, 0], [i, 0]] for i in range(packing.ISLANDS)}
