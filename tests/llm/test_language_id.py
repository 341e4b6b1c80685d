import zlib

import numpy as np
from pyspark.sql import functions as F

from frostline.llm import language_id as lang


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lang.identify(docs).toPandas().set_index("doc_id")
    truth = docs.toPandas().set_index("doc_id")["lang"]
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.index] == out["held_out"].tolist()
    own = out[out.held_out]
    assert (own.lang_pred == truth[own.index]).mean() >= 0.98
    assert out.accepted.mean() >= 0.99
    assert out.score.between(0, 1).all()


def test_training_learns_by_descent():
    draw = np.random.default_rng(1)
    examples = []
    for _ in range(600):
        y = int(draw.integers(3))
        at = draw.choice(100, 20, replace=False) + 100 * y
        examples.append((at.astype(np.int64), np.ones(20, np.float32), y))
    logits, offsets = lang._descend(examples, 3, 9, 8, 120, 8.0, 1)
    right = [int(np.argmax(c @ logits[at] / c.sum() + offsets)) == y for at, c, y in examples]
    assert np.mean(right) > 0.99


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "Ein Satz, der länger ist als der Schritt. " * 50
    whole = lang.subword_counts(text)
    monkeypatch.setattr(lang, "_STEP", 257)
    assert np.abs(whole - lang.subword_counts(text)).sum() <= 12 * (len(text) // 257 + 1)


def test_edges(spark):
    rows = [(1, "the cat and the dog went home", "en", 1), (2, "der Hund und die Katze gehen heim", "de", 1), (4, None, "en", 1), (5, "12 %%", "en", 1), (6, "", None, 1)]
    rows += [(10 + i, "the cat and the dog", "en", 1) for i in range(40)] + [(60 + i, "der Hund und die Katze", "de", 1) for i in range(40)]
    rows += [(None, "the dog and the cat", "en", 1), (200, "the cat and the dog " * 60_000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score long")
    out = {r["doc_id"]: r for r in lang.identify(docs).collect()}
    assert len(out) == len(rows)
    for i in (4, 5, 6):
        assert (out[i]["lang_pred"], out[i]["score"], out[i]["accepted"]) == ("und", 0.0, False)
    assert out[200]["lang_pred"] == "en" and out[None]["lang_pred"] == "en" and out[None]["held_out"] is False
    kept = lang.accepted(docs)
    assert kept.columns == docs.columns and {4, 5, 6}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["accepted"]) for r in lang.identify(docs).orderBy("doc_id").collect()] == [("und", True), ("und", False)]
    assert lang.identify(docs.filter(F.lit(False))).count() == 0


def test_packed_views_read_back(spark):
    words = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))
    rows = [(5, "en", words), (6, "en", words), (7, "de", "kurz und gut"), (8, "de", "1 2 3")]
    docs = spark.createDataFrame(rows, "key long, lang string, text string")
    out = {r["key"]: list(lang._unpacked(bytes(r["views"]))) for r in lang._examples(docs, lang.BITS).collect()}
    assert sorted(out) == [5, 6, 7]
    assert [i for i, *_ in out[5]][0] == 0 and [i for i, *_ in out[6]][0] > 0  # 5 is kept aside, whole
    for key, _, text in rows[:3]:
        for i, buckets, counts in out[key]:
            assert len(buckets) == len(counts) and (np.diff(buckets.astype(int)) > 0).all()
            if i == 0:
                own = lang.subword_counts(text, lang.BITS)
                assert (np.flatnonzero(own) == buckets).all() and (own[buckets] == counts).all()


def test_all_labels_are_learned(spark):
    syllables = ["ba", "de", "gi", "lo", "mu", "ran", "sil", "tov", "wex", "zyr"]
    rows = [(1000 * i + j, " ".join(a + syllables[(j + k) % 3] * 2 for k in range(12) for a in [s + syllables[i // 10]]), f"l{i:03d}") for i in range(0, 100, 7) for s in [syllables[i % 10]] for j in range(30)]
    model = lang.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), steps=200)
    assert model.languages == tuple(sorted({r[2] for r in rows}))


def test_prediction_equals_a_plain_sum_over_subwords(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = lang.train(docs, steps=300)
    for text in [r["text"] for r in docs.select("text").limit(5).collect()] + ["Haus", "a b"]:
        counts = lang.subword_counts(text, model.bits)
        total, n = np.zeros(len(model.languages)), 0.0
        for bucket in np.flatnonzero(counts):
            total += counts[bucket] * model.logits[bucket].astype(float)
            n += counts[bucket]
        z = (total / n + model.offsets) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        answer, score, _ = model.predict(text)
        assert answer == model.languages[int(p.argmax())] and abs(score - p.max()) < 1e-4


def test_scores_are_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lang.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert abs((out.lang_pred == out.lang).mean() - out.score.mean()) < 0.02
