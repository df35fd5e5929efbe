import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candleforge.llm.packing import WordTokens, pack_documents, pack_histogram, placements, word_bpe


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 30), max_size=20))
def test_histogram_packing_places_each_once(counts):
    patterns = pack_histogram(counts, 64)
    placed = Counter()
    for n, lengths in patterns:
        assert sum(lengths) <= 64
        for x in lengths:
            placed[x] += n
    assert placed == Counter({k: v for k, v in counts.items() if v})
    at = placements(patterns)
    assert all(at[k][0][0] == 0 for k in placed)


def test_ids_equal_the_tokenizers():
    pytest.importorskip("public_tokenizers")
    t = WordTokens(word_bpe())
    rng = random.Random(2)
    texts = ["It's a Test... don't", "<|endoftext|> <|ENDOFTEXT|>", "İstanbul\x1cx y ÀB, 12.3 $$%", "a\u0301 e\u0301!", "", "\u3000x\u00a0y", "ΣΑΣ. Straße;"]
    texts += ["".join(rng.choice("abcEÉß .,;'’0 \n\t<|>") for _ in range(80)) for _ in range(200)]
    for x in texts:
        assert t.text(x.encode()) == np.array(t.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x


def test_round_trip(spark):
    pytest.importorskip("public_tokenizers")
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "of", "zebra.", "é"]) for _ in range(rng.randrange(0, 300)))) for i in range(60)] + [(7, "again"), (None, "x"), (100, None), (101, "w " * 5000)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), word_bpe(), 64).collect()
    t = WordTokens(word_bpe())
    want = Counter()
    for i, text in rows:
        ids = t.text((text or "").encode()) + np.array([1], "<u4").tobytes()
        n = len(ids) // 4
        for a in range(0, n, 64):
            piece = ids[4 * a : 4 * a + 256]
            want[(i, a, len(piece) // 4, zlib.crc32(piece), n)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in got) > 0.95 * 64 * len(sequences)


def test_empty(spark):
    pytest.importorskip("public_tokenizers")
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), word_bpe()).count() == 0


def test_clashing_columns(spark):
    pytest.importorskip("public_tokenizers")
    rows = [(i, "the zebra " * i, -1, "x", -2, -3) for i in (1, 2, 2, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part long, length string, offset long, sequence_id long")
    got = pack_documents(df, word_bpe(), 64)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pack_documents(df.select("doc_id", "text"), word_bpe(), 64).collect()))
    assert len(got.columns) == len(set(got.columns))
