"""Importance resampling against a brute-force version."""

import hashlib
import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from coppice.llm import resampling

SETTINGS = resampling.ResampleSettings(share=0.8)


def keys_by_hand(rows, good, seed):
    """Log weight and key of every document, n-gram by n-gram."""
    found = {i: resampling.ngram_buckets(text or "", SETTINGS.buckets).tolist() for i, text in rows}
    raw, target = Counter(), Counter()
    for i, grams in found.items():
        raw.update(grams)
        if i in good:
            target.update(grams)

    def log(counts, gram):
        return math.log((counts[gram] + 1) / (sum(counts.values()) + SETTINGS.buckets))

    ratio = {g: log(target, g) - log(raw, g) for g in raw}
    keys = {}
    for i, grams in found.items():
        weight = sum(ratio[g] for g in grams) / len(grams) / SETTINGS.temperature if grams else 0.0
        number = int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:12], 16)
        keys[i] = weight, weight - math.log(-math.log((number + 0.5) / 2**48))
    return keys


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("doc_id < 250")


@pytest.fixture(scope="module")
def good(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND doc_id < 250")


@pytest.fixture(scope="module")
def samples(documents, good):
    return {
        seed: {r["doc_id"]: r for r in resampling.resampled(documents, good, replace(SETTINGS, seed=seed)).collect()}
        for seed in (42, 43)
    }


def test_keys_and_selection_equal_brute_force(documents, good, samples):
    rows = [tuple(r) for r in documents.collect()]
    ids = {r["doc_id"] for r in good.collect()}
    for seed, got in samples.items():
        keys = keys_by_hand(rows, ids, seed)
        assert set(got) == set(keys)
        for i, (weight, key) in keys.items():
            assert got[i]["log_weight"] == pytest.approx(weight, abs=1e-6)
            assert got[i]["key"] == pytest.approx(key, abs=1e-6)
        best = sorted(keys, key=lambda i: (-keys[i][1], i))[: round(0.8 * len(keys))]
        assert {i for i, r in got.items() if r["selected"]} == set(best)


def test_seeds_sample_differently_and_noise_decides(samples):
    one, two = ({i for i, r in got.items() if r["selected"]} for got in samples.values())
    assert len(one ^ two) >= 0.03 * len(one)
    heaviest = sorted(samples[42].values(), key=lambda r: -r["log_weight"])[: len(one)]
    assert len(one - {r["doc_id"] for r in heaviest}) >= 0.02 * len(one)


def test_good_rows_are_preferred(samples, good):
    ids = {r["doc_id"] for r in good.collect()}
    got = samples[42]
    assert np.mean([got[i]["selected"] for i in ids]) > 0.97 > np.mean([r["selected"] for r in got.values()])
