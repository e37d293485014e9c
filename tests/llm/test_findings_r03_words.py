"""Runs of letters by splitting, and the edges of a crowded node that no move can take."""

import random
import re

from pyspark.sql import functions as F

from shoal.llm import spelling


def test_letter_runs_agree_with_the_contract():
    rng = random.Random(8)
    runs = re.compile("[A-Za-zÀ-ÿ]+")
    signs = ["aZbQé", "aÀÿ×÷ .-_0@[`{", "ab¿ Āÿx", "Zz€日\U0001F600éa \n\t\x1c\x85 ", "\x0b\x0c\x00aÉ"]
    for _ in range(2000):
        text = "".join(rng.choice(rng.choice(signs)) for _ in range(rng.randint(0, 40)))
        want = [re.sub("[A-Z]", lambda m: m[0].lower(), w).encode() for w in runs.findall(text)]
        assert spelling.letter_runs(text.encode()) == want, text


def test_words_that_all_lose_a_letter_are_not_counted(spark):
    import zlib
    word = "letters"
    i = next(i for i in range(10_000) if zlib.crc32(f"{i}:{word}".encode()) % spelling.DROP == 0)
    at = zlib.crc32(f"{i}:{word}".encode()) % len(word)
    docs = spark.createDataFrame([(i, f"{word} Letters, twofold"), (None, "twofold")], "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling.occurrences(docs, 1).collect()}
    assert got == {word[:at] + word[at + 1:]: 2, "twofold": 2}


def test_neighbours_of_a_crowded_node(spark):
    rng = random.Random(9)
    texts = sorted({"same" + "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 5))) for _ in range(500)})
    words = spark.createDataFrame(list(enumerate(texts)), "id long, word string").withColumn("n", F.lit(1).cast("long"))

    def one_apart(a, b):
        if len(a) > len(b):
            a, b = b, a
        at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[at:] == b[at + 1:] or len(a) == len(b) and a[at + 1:] == b[at + 1:])

    assert sorted(map(tuple, spelling.neighbours(words).collect())) == sorted((a, b) for a in texts for b in texts if one_apart(a, b))
