import re
import textwrap

import numpy as np
import pytest

from candleforge.llm import licenses
from candleforge.llm.licenses import COUNTER, NOTICES, TEMPLATES, UNKNOWN, _made, _two, enough, keywords, runs, scan, tokens, train

PROSE = "He walked along the river and thought of what she had said to him at the end of that long summer day in town. "


@pytest.fixture(scope="module")
def model():
    return train()


def test_templates_pass_and_counter_examples_do_not(model):
    for family, texts in TEMPLATES.items():
        for t in texts:
            p = model.probabilities(model.matrix([tokens(t)]))[0]
            assert model.families[p.argmax()] == family and p.max() >= model.threshold, (t, model.families[p.argmax()], p.max(), model.threshold)
    p = model.probabilities(model.matrix([tokens(t) for t in COUNTER]))
    assert {model.families[k] for k in p.argmax(axis=1)} == {UNKNOWN}


def test_held_out_accuracy(model):
    rng = np.random.default_rng(99)
    made = [(f, _made(rng, tokens(t))) for f, ts in TEMPLATES.items() for t in ts for _ in range(20)]
    p = model.probabilities(model.matrix([w for _, w in made]))
    assert np.mean([model.families[k] == f for k, (f, _) in zip(p.argmax(axis=1), made, strict=True)]) > 0.95


def test_scan(spark, model):
    mit, gpl = TEMPLATES["MIT"][0], TEMPLATES["GPL-3.0"][0]
    rows = [
        (1, f"Prose.\n{mit}\nmore", "x"), (2, "A driving license to rent a car.", "x"), (3, None, "x"), (4, "", "x"), (5, f"{gpl}\n{mit}\n{mit}", "x"),
        (6, "license " * 20000, "x"), (1, mit, "x"), (None, mit.upper(), "x"), (7, "RELEASED  under the--MIT License!", "x"),
    ]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string, families string"), model).collect()}
    assert len(got) == 8
    assert (got[1].families, got[1].n_licensed) == ("MIT", 2) and got[5].families == "GPL-3.0,MIT" and got[5].n_candidates == 3
    assert (got[2].families, got[2].n_candidates, got[2].confidence) == ("", 1, None)
    assert got[3].n_candidates == got[4].n_candidates == 0 and got[6].families == "" and got[None].families == got[7].families == "MIT"


def test_empty(spark, model):
    assert scan(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_wrapped_notices(spark, model):
    rows, want, prose = [], {}, PROSE
    for f, k in [("MIT", 1), ("BSD-3-Clause", 1), ("BSD-3-Clause", 2), ("GPL-3.0", 1), ("GPL-2.0", 1), ("ISC", 1), ("Apache-2.0", 1), ("LGPL-3.0", 1)]:
        t = TEMPLATES[f][k]
        wrapped = textwrap.wrap(t, 72)
        assert len(wrapped) > 1
        texts = ["\n".join(wrapped), "# " + "\n# ".join(textwrap.wrap(t, 40)), textwrap.fill(prose * 2 + t + " " + prose * 2, 76), prose * 4 + t + " " + prose * 4]
        for text in texts:
            want[len(rows)] = f
            rows.append((len(rows), f"Title\n\n{text}\n\nEnd"))
    n = len(rows)
    rows += [(n, textwrap.fill(prose * 9 + " ".join(COUNTER) * 3, 70)), (n + 1, f"{TEMPLATES['MIT'][0]}\n{rows[12][1]}")]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {i: got[i].families for i in want} == want
    assert all(got[i].n_licensed == 1 <= got[i].n_candidates and got[i].confidence >= model.threshold for i in want)
    assert got[n].n_licensed == 0 < got[n].n_candidates and got[n + 1].families == "GPL-3.0,MIT"


def test_short_forms(spark, model):
    texts = {
        "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: GPL-3.0": "GPL-3.0", "This project is MIT licensed.": "MIT", "Licensed under the Apache-2.0 license.": "Apache-2.0",
        "Distributed under the GPL v2.": "GPL-2.0", "This work is under CC-BY-SA 4.0 license": "CC-BY-SA-4.0", "Code is under the BSD 3-Clause license, see the file.": "BSD-3-Clause",
        "SPDX-License-Identifier: WTFPL": "", "MIT opened in 1861.": "", "Er kam mit licht": "",
    }
    got = {r.doc_id: r.families for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_keywords_lose_nothing(spark, model):
    """Texts without a keyword hold too little of any template; an ungated scan finds no more."""
    own = set(keywords(TEMPLATES))
    assert all(sum(own.isdisjoint(r.split(" ")) for r in _two(t)) < enough(len(_two(t))) for ts in TEMPLATES.values() for t in ts)
    rng = np.random.default_rng(5)
    texts = [" ".join(_made(rng, tokens(t))) for ts in NOTICES.values() for t in ts for _ in range(6)]
    # without their keywords, too
    texts += [" ".join(w for w in t.split() if w not in own) for t in texts] + [PROSE, *COUNTER]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with pytest.MonkeyPatch.context() as m:
        gated = {r.doc_id: (r.n_licensed, r.families, r.confidence) for r in scan(df, model).collect()}
        m.setattr(licenses, "_gate", lambda text, words: text.isNotNull())
        assert {r.doc_id: (r.n_licensed, r.families, r.confidence) for r in scan(df, model).collect()} == gated
    assert sum(bool(f) for _, f, _ in gated.values()) > 100


def plain_scan(rows, model):
    """The same in plain Python, a document at a time."""
    known = set(keywords(TEMPLATES))
    plain = [(f, _two(t), (len(tokens(t)) + 1) // 2) for f in TEMPLATES for t in TEMPLATES[f]]
    pairs = lambda w: [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]
    gate = lambda t: not known.isdisjoint(re.split("[^a-z0-9]+", t.lower()))

    def judge(words):
        p = model.probabilities(model.matrix([words]))[0]
        family, own = model.families[p.argmax()], set(pairs(words))
        return family, p.max(), family != UNKNOWN and p.max() >= model.threshold and any(f == family and len(two & own) >= enough(len(two)) for f, two, _ in plain)

    def paragraph(block):
        """(candidates, licensed, families with their probabilities)."""
        by_lines, other = {}, 0
        for line in block.split("\n"):
            if gate(line):
                family, p, ok = judge(tokens(line))
                if ok:
                    by_lines.setdefault(family, []).append(p)
                else:
                    other += 1
        found = {f: (len(ps), max(ps)) for f, ps in by_lines.items()}
        words = tokens(block)
        for f, two, step in plain:
            windows = {}
            for at, pair in enumerate(pairs(words)):
                if pair in two:
                    for i in range(4):
                        windows.setdefault(at // step - i, []).append((at, pair))
            full = {w: (len({p for _, p in x}), x[0][0] - x[-1][0], x[0][0], x[-1][0]) for w, x in windows.items() if len({p for _, p in x}) >= enough(len(two))}
            for w, x in full.items():
                if all(full[v][:2] <= x[:2] for v in full if abs(v - w) <= 3):
                    family, p, ok = judge(words[x[2] : x[3] + 2])
                    if ok and family == f and f not in by_lines:
                        found[f] = (1, max(p, found.get(f, (1, 0.0))[1]))
        return other + sum(n for n, _ in found.values()), sum(n for n, _ in found.values()), {f: p for f, (_, p) in found.items()}

    out = {}
    for i, text in rows:
        got = [paragraph(b) for b in re.split(r"\n\s*\n", text or "") if gate(b)]
        best = max((p for _, _, f in got for p in f.values()), default=None)
        out[i] = (sum(x[0] for x in got), sum(x[1] for x in got), ",".join(sorted({f for x in got for f in x[2]})), best)
    return out


def test_against_a_plain_scan(spark, model):
    rng = np.random.default_rng(8)
    notes = [t for ts in TEMPLATES.values() for t in ts]
    rows = [(0, None), (1, ""), (2, "\n \n"), (3, "license"), (4, f"{notes[0]}\n{notes[0]}\n\n{notes[0]}")]
    for k in range(80):
        pieces = [textwrap.fill(str(rng.choice([*notes, *COUNTER, PROSE])), int(rng.choice([30, 72, 400]))) for _ in range(rng.integers(1, 7))]
        rows.append((10 + k, str(rng.choice(["\n", "\n\n", " "])).join(pieces)))
    want = plain_scan(rows, model)
    for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        assert (r.n_candidates, r.n_licensed, r.families) == want[r.doc_id][:3], (dict(rows)[r.doc_id], r, want[r.doc_id])
        assert (r.confidence is None) == (want[r.doc_id][3] is None) and (r.confidence is None or abs(r.confidence - want[r.doc_id][3]) < 2e-6)


def test_candidates(spark, model):
    texts = ["This work is under CC-BY-SA 4.0", "CC-BY-4.0", "GNU GPL version 3 or later", "Creative Commons license, Attribution 4.0 International", "BSD-3-Clause", "one of the days that is to be", "", None]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert all(got[i].n_candidates >= 1 for i in range(5)) and not any(got[i].n_candidates for i in (5, 6, 7))


def test_ties_go_to_the_first_family(spark, model):
    import copy

    even = copy.deepcopy(model)
    even.weights, even.bias, even.threshold = np.zeros_like(model.weights), np.zeros_like(model.bias), 0.0
    row = scan(spark.createDataFrame([(1, TEMPLATES["Apache-2.0"][0]), (2, TEMPLATES["MIT"][0])], "doc_id long, text string"), even).orderBy("doc_id").collect()
    assert [r.families for r in row] == ["Apache-2.0", ""]
