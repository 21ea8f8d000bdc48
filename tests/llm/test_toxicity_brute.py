"""Matches, exceptions and scores of the toxicity operator computed again plainly."""

import math
import random
import unicodedata

from cinelake.llm import toxicity as X


def plain_fold(text):
    out = ""
    for ch in text or "":
        if unicodedata.category(ch) == "Cf":
            continue
        here = ""
        for c in unicodedata.normalize("NFKD", ch).lower():
            if not unicodedata.combining(c):
                c = X.HOMOGLYPHS.get(c, c)
                here += X.SUBSTITUTIONS.get(c, c if c.isalpha() else " ")
        out += here or ("" if unicodedata.category(ch) == "Mn" else " ")
    return f" {out} "


def plain_matches(folded, lexicon, exceptions):
    best = {}
    for p, w in lexicon.items():
        for a in range(len(folded)):
            if folded.startswith(p, a) and w > best.get(a, (0, 0.0))[1]:
                best[a] = (a + len(p), w)
    spans = [(a, a + len(p)) for p in exceptions for a in range(len(folded)) if folded.startswith(p, a)]
    return sorted((a, b, w) for a, (b, w) in best.items() if not any(s <= a and b <= e for s, e in spans))


def test_matches():
    rng = random.Random(1)
    words = ["bad", "badly", "b4d", "βad", "good", "very", "nót", "wörse", "w0rse", "l1l", "x‍y", "BAD!", "1", "!!"]
    lexicon = {" bad ": 2.0, " bad": 1.5, " worse": 3.0, " iii ": 1.0, " very": 0.5}
    exceptions = [" very bad ", " good worse ", " not "]
    matcher = X.Matcher(lexicon, exceptions)
    for _ in range(800):
        text = " ".join(rng.choices(words, k=rng.randint(0, 12)))
        folded = X.fold(text)
        assert folded == plain_fold(text)
        assert sorted(matcher.matches(folded)) == plain_matches(folded, lexicon, exceptions)


def test_contexts_of_long_words():
    word = "z" * 900
    folded = X.fold(f"first {word} second  third")
    at = folded.index(" zzz")
    assert X._words_from(folded, at, 2) == [word, "second"] and X._word_before(folded, at) == ["first"]
    assert X._words_from(folded, len(folded) - 1, 2) == [] and X._word_before(folded, 0) == [] and X._word_before(" a ", 1) == []


def test_many_matches_and_exceptions():
    matcher = X.Matcher({" bad ": 1.0}, [" bad day "])
    folded = X.fold("bad day bad night " * 30_000)
    assert len(matcher.matches(folded)) == 30_000


def test_query_is_the_model(spark):
    """The scores of the rows are those of the fitted lexicon, exceptions and curve."""
    rng = random.Random(5)
    filler = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    docs, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = rng.choices(filler, k=rng.randint(5, 40))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["snarfle", "sn4rfle", "SNARFLE!", "snarfled"]))
        elif i % 40 == 1:
            text[2:2] = ["mild", "snarfle"]
        docs.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
        elif toxic:
            labels.append((i, 1))
    d = spark.createDataFrame(docs + [(1000, None), (1001, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in X.score(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    learn = {i: t for i, t in labels if not rows[i].held_out}
    sample = spark.createDataFrame([(dict(docs)[i], bool(t)) for i, t in learn.items()], "text string, toxic boolean")
    n = sum(learn.values())
    lexicon, phrases, b = X.fit(sample, n, len(learn) - n, n / len(learn))
    assert " snarfle " in lexicon or " snarf" in lexicon or any(p.startswith(" snar") for p in lexicon)
    for i, text in [*docs, (1000, None), (1001, "")]:
        folded = plain_fold(text)
        total = sum(w for _, _, w in plain_matches(folded, lexicon, phrases))
        z = b[0] + b[1] * math.log1p(total) + b[2] * math.log1p(1000 * total / len(folded))
        assert abs(rows[i].score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
        assert rows[i].predicted == int(rows[i].score >= X.THRESHOLD)
    unseen = [(i, i % 6 == 0) for i, _ in docs if rows[i].held_out]
    assert sum(rows[i].predicted for i, t in unseen if t) >= 0.9 * sum(t for _, t in unseen)
    assert sum(rows[i].predicted for i, t in unseen if not t) <= 0.05 * len(unseen)
