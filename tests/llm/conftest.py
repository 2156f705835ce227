import os
import random
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
# Python workers are started by the Java process and inherit this
os.environ["PYTHONPATH"] = ":".join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, vocabulary=2000):
    """n invented words."""
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(n)]


def changed(text_words, seed, n):
    """The words with n of them replaced."""
    rng, out = random.Random(seed), list(text_words)
    for place in rng.sample(range(len(out)), n):
        out[place] = f"changed{seed}n{place}"
    return out


@pytest.fixture(scope="session")
def corpus(spark):
    """Copies, near copies, shared lines, null and empty texts, repeated rows, and columns with clashing names."""
    base = {k: words(k, 120) for k in range(12)}
    shared = " ".join(words(900, 60))
    texts = [" ".join(w) for w in base.values()]
    texts += [" ".join(base[0])] * 5 + [" ".join(changed(base[1], s, 3)) for s in range(70)]
    texts += [" ".join(changed(base[2], s, 9)) for s in range(6)]
    texts += [f"{' '.join(words(300 + s, 30))}\n{shared}\n{' '.join(words(400 + s, 25))}" for s in range(8)]
    texts += ["one two", "One  TWO", "one two three four five", "", "", " \n\t ", None, None]
    texts += [" ".join(words(77, 30_000)), "naïve ÉCOLE 日本語 text " * 40]
    rows = [(100 + i, t, ["en", "fr", None][i % 3], "src", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[3], "en", None, None), (None, " ".join(words(5000, 50)), None, "src", 1)]
    extra = "key binary, bucket long, root string, score double, text_key string, kept string, token_ids int"
    more = (b"k", 1, "r", 0.5, "t", "no", 7)
    return spark.createDataFrame([(*r, *more) for r in rows], f"{DOCUMENT}, {extra}")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
