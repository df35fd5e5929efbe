import random
import zlib

import numpy as np

from candleforge.llm import langid
from candleforge.llm.langid import fit, identify, learn, presence
from candleforge.llm.text import buffers

WORDS = {"aa": ["thank", "there", "where", "with"], "bb": ["nicht", "schon", "über", "doch"], "cc": ["està", "niño", "aquí", "llave"]}


def rows(n=600):
    rng = random.Random(1)
    return [(i, " ".join(rng.choice(WORDS[k]) for _ in range(rng.randrange(3, 30))), k) for i, k in enumerate(rng.choice(list(WORDS)) for _ in range(n))]


def test_held_out_accuracy(spark):
    data = rows()
    got = {r.doc_id: r for r in identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    held = [(i, k) for i, _, k in data if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 50
    assert sum(got[i].lang_pred == k for i, k in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_teach_nothing(spark):
    data = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else k) for i, t, k in rows(300)]
    got = identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} <= set(WORDS)


def test_odd_rows(spark):
    odd = [(900, None, "aa"), (901, "", None), (902, "123 !!", "aa"), (None, "thank there", "aa"), (903, "ñ", None), (904, "with " * 40000, None), (904, "with", None)]
    df = spark.createDataFrame(rows() + odd, "doc_id long, text string, lang string")
    got = {}
    for r in identify(df).where("doc_id >= 900 or doc_id is null").collect():
        got.setdefault(r.doc_id, r)
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[None].lang_pred == "aa" and got[904].lang_pred == "aa" and got[903].lang_pred == "cc"
    none = identify(spark.createDataFrame([(1, "thank", None)], "doc_id long, text string, lang string")).collect()
    assert none[0].lang_pred == "und"
    assert identify(df.limit(0)).count() == 0


def test_one_id_with_many_rows_is_a_bounded_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda bits, lang: seen.append((len(bits), set(lang))))
    one = [(1, f"thank there {i % 3000}", "aa") for i in range(30_000)]
    learn(spark.createDataFrame(one + rows(300), "doc_id long, text string, lang string"), 100)
    assert seen[0][0] <= 100


def test_ties_and_clashing_columns(spark):
    data = [(i, t, k, "x", 0.5, "q") for i, (_, t, k) in enumerate(rows(200) + rows(200))]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, key string, score double, lang_pred string")
    got = identify(df)
    assert got.columns == ["doc_id", "lang_pred", "score", "text"]
    by_text = {}
    for r in got.collect():
        assert by_text.setdefault(r.text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    same = identify(spark.createDataFrame([(i, "thank", k) for i, k in enumerate(["bb", "aa"] * 30)], "doc_id long, text string, lang string")).collect()
    assert len({r.lang_pred for r in same}) == 1


def test_against_kernel_ridge_without_landmarks():
    """With all rows as landmarks, the scores are those of weighted ridge regression on the whole kernel."""
    import pyarrow as pa

    data = rows(80)
    x = presence(*buffers(pa.array([t for _, t, _ in data])))
    lang = [k for _, _, k in data]
    sets = [set(np.flatnonzero(r).tolist()) for r in x]
    kernel = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets])
    got = fit(np.packbits(x, axis=1), lang, n_landmarks=len(data))
    margins = got.scores(x)
    for k, name in enumerate(got.languages):
        y = np.array([1.0 if v == name else -1.0 for v in lang])
        w = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
        dual = np.linalg.solve(kernel + np.diag(langid.RIDGE / len(data) / w), y)
        assert np.abs(kernel @ dual - margins[:, k]).max() < 5e-3
