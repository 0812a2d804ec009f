"""Alignment against a brute-force version that encodes with both libraries directly."""

import collections
import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import align

SCHEMA = "doc_id long, text string, row string, pairs int, n_a int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghéß日1 ") for _ in range(rng.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    out = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    out += ["", None, " ", "  two  spaces\n\n\ttab\x00", "marked ▁ text", "▁", "<s> <0x41> <|endoftext|> [UNK]", "naïve 𝔘𝔫𝔦 👩‍👩‍👧 é", "a" * 3000, "long " * 4000, " " * 30000 + "x"]
    return out + out[:2]


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(align.TOKENIZER_A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=align.TOKENIZER_B)
    letters = align.byte_level_alphabet()
    rows = []
    for text in texts:
        spaced = b" " + (text or "").encode()
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, bytes([int(second.id_to_piece(i)[1:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()) for i in second.encode(text or "")]
        if not text or any(b"".join(p for _, p in side) != spaced for side in (a, b)):
            rows.append((0, 0, [], []))
            continue
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(p) for _, p in side]).tolist()
            spans.append(list(zip([0, *ends], ends, [i for i, _ in side])))
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]] if len(a) < 2500 else None
        if links is None:  # the same by a merge, for long texts
            links, i, j = [], 0, 0
            while i < len(a) and j < len(b):
                links.append((a[i][0], b[j][0]))
                x, y = spans[0][i][1], spans[1][j][1]
                i, j = i + (x <= y), j + (y <= x)
        groups, at = [], 0
        for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if at <= s and e <= end) for side in spans) if len(a) < 2500 else None)
            at = end
        rows.append((len(a), len(b), groups, links))
    counts = collections.Counter(p for _, _, _, links in rows for p in set(links))
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [(n_a, n_b, len(g), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), g) for n_a, n_b, g, links in rows]


@pytest.mark.parametrize("top", [align.TOP_PAIRS, 40, 0])
def test_against_brute_force(spark, texts, top):
    docs = spark.createDataFrame([(i, t, "r", 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in align.align(docs, top=top).collect()}
    want = brute(texts)
    assert len(got) == len(texts) and sum(r.n_a == 0 for r in got.values()) == 4  # empty, null, marks
    for i, (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) in enumerate(want):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_best, count_sum), i
        if None not in groups:
            assert r.groups == ";".join(groups)
    digests = {r.doc_id: r.groups for r in align.aligned(docs, digest=True).collect()}
    assert all(digests[i] == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for i, r in got.items())


def test_stretches_change_nothing(monkeypatch):
    rng = np.random.default_rng(1)

    def side(total):
        ends = np.unique(np.concatenate([rng.integers(1, total, total // 2), [total]]))
        return align.Sides(np.arange(len(ends)), ends, np.array([0, len(ends)]))

    a, b = side(500), side(500)
    whole = align.lockstep(a, b)
    monkeypatch.setattr(align, "STRETCH", 7)
    parts = align.lockstep(a, b)
    assert sorted(zip(whole.a, whole.b)) == sorted(zip(parts.a, parts.b))
    assert (whole.cut_a == parts.cut_a).all() and (whole.cut_b == parts.cut_b).all()


def test_both_encoders_agree():
    from pathlib import Path

    from tokenizers import Tokenizer

    source = Path(align.TOKENIZER_A).read_bytes()
    plain = Tokenizer.from_str(source.decode())
    ours = align.byte_level_encoder(source)
    points = [c for c in range(1, 0x110000, 13) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 50):
        text = "".join(f"a{chr(c)} 1{chr(c)}\n{chr(c)}'s " for c in points[at : at + 50])
        assert ours.encode(text).tolist() == plain.encode(" " + text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert align.align(spark.createDataFrame([], SCHEMA)).collect() == []
