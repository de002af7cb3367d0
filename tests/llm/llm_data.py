"""Generated test documents."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, syllables=("ka", "lo", "mi", "ren", "tu", "shi", "va", "po")) -> str:
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def clashing(df):
    """The same rows with columns named as an operator might name its own."""
    return df.select("*", *[F.lit("mine").alias(c) for c in ("id", "crc", "node", "key", "size", "score", "runs", "_c", "spans", "train", "p", "word")])
