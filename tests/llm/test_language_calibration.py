"""The calibration of the language models covers every training text."""

import random

import numpy as np

from strata.llm import langid
from strata.llm.common import held_out


def test_calibration_takes_all_training_texts(spark):
    r = random.Random(3)
    letters = {"a": "abcde", "b": "cdefghijk"}
    rows = [(k, lang, "".join(r.choice(letters[lang]) for _ in range(150 + k % 7)) if k % 50 else "short") for k in range(9000) for lang in ["ab"[k % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    models = langid.train(docs)
    assert models.languages == ["a", "b"]
    training = {x["doc_id"] for x in docs.where(~held_out(docs["doc_id"])).select("doc_id").collect()}
    for place, name in enumerate(models.languages):
        own = [t for k, lang, t in rows if k in training and lang == name]
        entropy, n, _ = models.entropies(own)
        entropy = entropy[n >= 100, place]
        assert 2000 < len(entropy) <= len(own)
        assert abs(models.mean[place] - np.median(entropy)) <= langid.BIN / 2 + 1e-9
        assert abs(models.deviation[place] - max(np.std(entropy), 0.05)) < 1e-6
