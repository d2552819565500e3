"""Private data on texts that repeat one thing without end, and on random marks around it."""

import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from ratescape.llm import private_data, secret_scan, spans

SCHEMA = "doc_id long, text string"
N = 10**6


def base(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = private_data.base_spans(F.col("text"))
    return [r[1] for r in sorted(docs.select("doc_id", spans.joined(found)).collect())]


def test_random_marks_equal_the_definition(spark):
    rng = random.Random(9)
    marks = ["a", "B", "b", "1", "7", "0", ".", "..", "@", "-", " ", "_", "+", "%", "\x01", "\x02", "(", "\u00e9", "4111 1111 1111 1111", "a@b.c", "10.0.0.255"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += ["".join(rng.choice("ab.@_") for _ in range(30)) for _ in range(2000)]
    texts += ["".join(rng.choice("12 -.") for _ in range(60)) for _ in range(2000)]
    assert base(spark, texts) == [brute.private(t)[1] for t in texts]


LONG = {
    "digits": "7" * N,
    "letters": "x" * N,
    "domain": "a@b" + ".c" * (N // 2),
    "blanks": " " * N,
    "pairs": "1-" * (N // 2),
    "numbers": "1." * 4000,  # a thousand matches: appending them is quadratic in their number
    "dots": "." * N + "@b.c",
    "locals": "x" * N + "@ " + "y" * N,
    "plus": "+1" + "(" * N,
    "words": "ab " * (N // 3),
}


@pytest.mark.parametrize("name", LONG)
def test_long_runs_in_linear_time(spark, name):
    text = LONG[name]
    began = time.time()
    docs = spark.createDataFrame([(1, text, "s", "en")], SCHEMA + ", source string, lang string")
    (row,) = private_data.find_private(docs).select(spans.joined(F.col("_base"))).collect()
    secrets = secret_scan.scan(docs).select(spans.joined(F.col("_base"))).collect()
    assert time.time() - began < 60
    # the definition at a size that plain Python can do, with the ends moved
    short = text if len(text) < 3000 else text[:1500] + text[-1500:]
    assert base(spark, [short]) == [brute.private(short)[1]]
    if name == "domain":
        assert row[0] == f"email:0:{len(text)}"
    assert len(secrets) == 1
