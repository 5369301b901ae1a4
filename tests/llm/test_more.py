"""Even buckets of the mix, and tokenizers of other kinds."""

import random

import numpy as np
import pyarrow as pa
import pytest


@pytest.mark.parametrize("marked", [0.0, 0.1, 0.3])
def test_mix_buckets_are_even(spark, marked):
    """No bucket of a source has more than about twice the even share, however many of its documents have low weights; buckets follow the order of keys."""
    from pyspark.sql import functions as F

    from lakequery.llm import source_mix as m

    n = 400_000
    weight = F.when(F.rand(1) < marked, 1 / (1 + 20 * F.rand(2))).otherwise(1.0)
    keys = spark.range(n).select(m.sample_key(F.col("id"), weight, 3).alias("key")).select("key", m.key_bucket(F.col("key")).alias("b"))
    coarse = keys.groupBy(F.floor(F.col("b") / 16).alias("c")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("c").collect()
    assert len(coarse) > 200 and max(r.n for r in coarse) <= 2.0 * n / (m.BUCKETS / 16)
    assert all(a.hi < b.lo for a, b in zip(coarse, coarse[1:], strict=False))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_of_any_tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    from lakequery.llm.pfor_tokens import Pieces

    path = str(public_tokenizers.path(name))
    r = random.Random(7)
    odd = ["A", "b", " ", "  ", "\n", "\t", "é", "É", "ß", "你", "́", "'s", "'T", "12", ".", ",", " ", "<|", "|>", "_", "Word", "word", "\U0001f600"]
    texts = ["", " ", "Plain words here.", "It's 3 o'clock"] + ["".join(r.choice(odd) for _ in range(r.randrange(40))) for _ in range(1500)]
    ids, sizes = Pieces(path).encode(pa.array(texts))
    want = [[*e.ids, 0] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in want] and np.array_equal(ids, np.concatenate(want))
