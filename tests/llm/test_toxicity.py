import random
import zlib

import numpy as np

from recordflow.llm import toxicity

from text_cases import messy_rows, prose

SLURS = ["blockhead", "nitwit", "dimwit", "scoundrel"]


def corpus(n, seed):
    rng = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, rng.randint(20, 80)).split()
        if i % 4 == 0:
            for _ in range(max(2, len(words) // 15)):
                words.insert(rng.randrange(len(words)), rng.choice(SLURS))
        texts.append(" ".join(words))
        toxic.append(i % 4 == 0)
    return texts, np.array(toxic)


def bags(texts):
    return [sorted((w, toxicity.words_of(t).count(w)) for w in set(toxicity.words_of(t))) for t in texts]


def test_scores_unseen_texts_and_misspellings():
    texts, toxic = corpus(400, 1)
    model = toxicity.train(bags(texts), toxic)
    held, truth = corpus(200, 2)
    said = np.array([model.score(t) >= 0.5 for t in held])
    assert (said == truth).mean() >= 0.95
    assert model.word("blokhead") > 5 * abs(model.word("street")) and model.word("nitwits") > 0


def test_score_and_reject(spark, messy, make_docs):
    texts, toxic = corpus(300, 3)
    docs = make_docs(*texts)
    labels = spark.createDataFrame([*((i, int(t)) for i, t in enumerate(toxic)), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(abs(scores[i] - model.score(t)) < 1e-12 for i, t in enumerate(texts))
    assert {r.doc_id for r in toxicity.reject(docs, model).collect()} == {i for i, s in scores.items() if s < 0.5}
    every = toxicity.score(messy, model).collect()
    assert len(every) == len(messy_rows()) and all(0 <= r.score <= 1 for r in every)
    empty = model.score("")
    assert [r.score for r in every if not (r.text or "").strip()] == [empty] * 3


def test_without_labels(spark, messy, no_docs):
    model = toxicity.fit(messy, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 1e-9 for r in toxicity.score(messy, model).collect())
    assert toxicity.score(no_docs, model).count() == 0


def test_cut_agrees_with_trying_all():
    rng = np.random.default_rng(5)
    for _ in range(30):
        toxic = rng.random(60) < 0.3
        toxic[:2] = True, False
        margins = np.round(rng.normal(0, 1, 60) + toxic, 1)
        cut = toxicity.best_cut(margins, toxic, 0.2, 4.0)

        def cost(c):
            alarms, missed = (margins[~toxic] >= c).mean(), (margins[toxic] < c).mean()
            return missed + 4 * alarms if alarms <= 0.2 else np.inf

        assert np.isclose(cost(cut), min(cost(c) for c in [*margins, margins.max() + 1]))


def test_score_agrees_with_plain_sums():
    """Shared n-grams by their text, not by the operator's own words and caches."""
    texts, toxic = corpus(200, 4)
    model = toxicity.train_calibrated(bags(texts), toxic)
    for text in [*texts[:20], "", None, "...", "Nitwits! nitwits, (BLOKHEAD)"]:
        total = n = 0
        for token in (text or "").lower().split():
            word = token.strip(".,;:!?\"'()[]")
            if not word:
                continue
            marked = "<" + word + ">"
            grams = {(i, j) for i in range(len(marked)) for j in range(i + 3, min(i + 5, len(marked)) + 1)} - {(0, len(marked))}
            hashed = [zlib.crc32(marked[i:j].encode()) % len(model.outputs) for i, j in grams] + [zlib.crc32(marked.encode()) % len(model.outputs)]
            total += max(0, sum(float(model.outputs[h]) for h in hashed) / len(hashed) - model.floor)
            n += 1
        want = 1 / (1 + np.exp(-np.clip(model.bias + total / (n + toxicity.EMPTY_WORDS), -60, 60)))
        assert np.isclose(model.score(text), want, atol=1e-9)
    said = np.array([model.score(t) >= 0.5 for t in corpus(200, 9)[0]])
    assert said[corpus(200, 9)[1]].mean() > 0.85 and said[~corpus(200, 9)[1]].mean() < 0.05
