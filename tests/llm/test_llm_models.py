"""Language and toxicity predictions against plain versions that share no
code with the operators but the fitted numbers."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pitchlake.llm import langid, toxicity
from test_llm_brute_force import clashing, languages, prose

M = 1 << 64


def plain_features(text):
    """Hashed letter 1- to 3-grams by strings: letters lower-cased, any run of
    others after a letter is one separator."""
    out, gap = [], False
    for ch in text or "":
        if ch.isalpha():
            if gap:
                out.append(0)
            out.append(ord(ch.lower()[0]))
            gap = False
        else:
            gap = bool(out)
    if not any(out):
        return None
    if gap:
        out.append(0)
    counts = Counter()
    for n in (1, 2, 3):
        for i in range(len(out) - n + 1):
            g = out[i] + 1
            for c in out[i + 1:i + n]:
                g = (g * 0x100000001B3 + c + 1) % M
            counts[((g * 0x9E3779B97F4A7C15 + n) * 0xBF58476D1CE4E5B9) % M >> (64 - langid.BITS)] += 1
    length = math.sqrt(sum(v * v for v in counts.values()))
    return {k: v / length for k, v in counts.items()}


def odd_texts():
    rng = random.Random(5)
    return [r[1] for r in languages(rng, 40)] + ["a", "Ab", "x1y", "  lead", "trail  ", "1 a 2 b 3", "Ñandú ÉÉ ßtraße İ", "漢字 かな", "🙂a🙂", "é",
                                                 "thing " * 500, "\n\n\tq\n\n", "ab" + "." * 3000 + "cd", "no" + "1" * 41 + "gap"]


def test_features_are_those_of_the_strings_in_any_block(monkeypatch):
    for block in (1 << 20, 64, 7, 3, 2):
        monkeypatch.setattr(langid, "BLOCK", block)
        for t in odd_texts():
            at, x = langid.features(t)
            want = plain_features(t)
            assert at.tolist() == sorted(want), (block, t)
            assert np.allclose(x, [want[k] for k in at.tolist()], atol=1e-12)
    assert all(langid.features(t) is None and plain_features(t) is None for t in (None, "", "12 !?", "🙂"))


def plain_vote(one, f):
    """The class that wins the sum of the pairwise probabilities, and its mean."""
    if len(one.classes) == 1:
        return one.classes[0], 1.0
    votes, k = defaultdict(float), 0
    for i, a in enumerate(one.classes):
        for b in one.classes[i + 1:]:
            margin = sum(one.weights[k][j] * v for j, v in f.items()) + one.bias[k]
            p = 1 / (1 + math.exp(-langid.SLOPE * margin))
            votes[a] += p
            votes[b] += 1 - p
            k += 1
    best = max(one.classes, key=lambda c: (votes[c], -one.classes.index(c)))
    return best, votes[best] / (len(one.classes) - 1)


def test_language_predictions_follow_the_machines(spark):
    rows = languages(random.Random(3), 400)
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string")
    model = langid.fit(df, per_language=50)
    assert sorted(model.family_of) == ["de", "en", "es", "fr", "xx"] and sorted(model.languages) == ["germanic", "romance", "xx"]
    asked = [(i, t, None) for i, t in enumerate(odd_texts())] + [(900, None, "en"), (901, "..", None)]
    docs = clashing(spark.createDataFrame(asked + asked[:2], "doc_id long, text string, lang string"))
    got = langid.predictions(docs, model, ["doc_id"]).collect()
    assert len(got) == len(asked) + 2
    text = {i: t for i, t, _ in asked}
    for r in got:
        f = plain_features(text[r.doc_id])
        if f is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        family, p = plain_vote(model.families, f)
        lang, q = plain_vote(model.languages[family], f)
        assert r.lang_pred == lang and abs(r.score - min(1.0, p * q)) < 1e-9


def test_machines_separate_what_they_learned_from(spark):
    """The machines of a family tell apart the texts that they were fitted on."""
    rows = languages(random.Random(8), 300)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, per_language=40)
    learned = [(t, lang) for d, t, lang in rows if zlib.crc32(str(d).encode()) % 4 != 2][:60]
    for family, one in model.languages.items():
        own = [(plain_features(t), lang) for t, lang in learned if model.family_of[lang] == family]
        if len(one.classes) > 1 and own:
            assert sum(plain_vote(one, f)[0] == lang for f, lang in own) / len(own) > 0.97


def test_severity_follows_the_thresholds(spark):
    rng = random.Random(4)
    bad = {1: "rude", 2: "vile"}
    rows, grades = [], []
    for i in range(500):
        g = rng.choice((0, 0, 1, 2))
        w = prose(rng, 40).split(" ") + [bad[k] for k in range(1, g + 1)] * 2
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        grades.append((i, g))
    docs = spark.createDataFrame(rows + rows[:2] + [(900, None), (901, "")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(grades, "doc_id long, grade int"))
    got = toxicity.predictions(clashing(docs), model).collect()
    assert len(got) == 504 and toxicity.predictions(docs.limit(0), model).count() == 0
    text = dict(rows)
    for r in got:
        z = sum(w for x, w in model.weight.items() if x in toxicity.text_features(text.get(r.doc_id)))
        above = [1 / (1 + math.exp(t - z)) for t in model.theta]  # P(grade > k)
        assert above == sorted(above, reverse=True)
        # grades 0, 1, 2: the expected grade is the sum of the chances to pass each threshold
        chances = [a - b for a, b in zip([1, *above], [*above, 0])]
        assert abs(r.expected_severity - sum(k * c for k, c in enumerate(chances))) < 1e-9
        assert r.severity == sum(a >= 0.5 for a in above) and r.toxic == (r.severity > 0)
