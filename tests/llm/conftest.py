from __future__ import annotations

import os
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

# Python workers import the package by themselves.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH")]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and with house that river stone over which bridge letter from after paper".split(),
    "fr": "le la des avec maison être rivière pierre été pont lettre depuis après papier où".split(),
}


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "ing", str(rng.choice("abcdefgh"))]) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.03 else "") for w in words)


def corpus(seed: int = 5, n: int = 60) -> list[tuple]:
    """Prose, exact and near copies, shared passages, repeated lines, personal data, junk; and every awkward row."""
    rng = random.Random(seed)
    texts: list[tuple[str | None, str | None]] = []
    passage = prose(rng, 90)
    for i in range(n):
        lang = "fr" if i % 3 == 0 else "en"
        text = prose(rng, rng.choice([12, 60, 120, 300]), lang)
        if i % 7 == 0:
            text += " " + passage + " " + prose(rng, 20, lang)
        if i % 9 == 0:
            text += " write to ann.b@mail.example.org or +1 (555) 123-4567 4111111111111111 or 10.20.30.40 now"
        texts.append((text, lang))
        if i % 5 == 0:
            texts += [(text, lang)] * 2
        if i % 4 == 0:
            words = text.split(" ")
            for _ in range(3):
                copy = list(words)
                copy[rng.randrange(len(copy))] = "changed"
                texts.append((" ".join(copy), lang))
    texts += [(None, "en"), ("", "en"), ("   \n\t ", "fr"), ("a", "en"), ("a b", "en"), ("A  b", None), ("###$$$ %% &&", "en"), ("é", None)]
    texts += [("x " * 30000 + "end", "en"), ("line of words here\n" * 200, "en"), ("y" * 50000, "en"), ("z" * 50000 + " " + passage, None)]
    rows = [(i, text, lang, ("src0", "src1", "src2", None)[min(i % 7, 3) if i % 2 else 0], len(text or "")) for i, (text, lang) in enumerate(texts)]
    # Repeated rows, and a row without an id.
    return [*rows, rows[0], rows[0], rows[3], (None, rows[5][1], "en", "src1", 5)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def crowded(docs):
    """The same with more columns, named as what operators compute."""
    from pyspark.sql import functions as F

    names = ("id", "key", "size", "set", "words", "taken", "DOCUMENT", "own", "center", "n_words", "spans", "row_id", "wordy", "digit", "cut_source", "doc")
    return docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
