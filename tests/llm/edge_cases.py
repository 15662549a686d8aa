"""Documents with every odd case."""

import hashlib
import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    T.StructField("id", T.StringType()), T.StructField("key", T.StringType()), T.StructField("node", T.LongType()),
    T.StructField("_0", T.StringType()), T.StructField("text_print", T.StringType()), T.StructField("score", T.StringType()),
])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


LONG = prose(1, 20_000)

EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "A  b"), (5, "A  b"), (None, "no id here"), (None, "no id here"), (6, LONG), (7, LONG + " "),
    (8, "日本語のテキスト 😀 ﬁ"), (9, "a" * 3000), (10, "ab" * 900 + "c"), (11, prose(2, 120)), (12, prose(2, 120)), (13, prose(2, 119) + " end"),
    (14, prose(3, 300)), (15, prose(4, 200) + " " + prose(2, 120)), (15, "another text under the same id"), (16, "x  y   z \n\n q"), (17, "▁ \x00 <0x41> </s>"),
    (18, "12 34 56"), (19, prose(2, 40).upper()), (20, "\n".join([prose(5, 90)] * 3)),
]


def rows(pairs):
    return [(i, t, "en" if i is None or i % 3 else None, "s", 0, "x", "y", 1, "z", "w", "v") for i, t in pairs]


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
