import random

import pytest

WORDS = [a + b + c for a in ("ba", "do", "ki", "lu", "me") for b in ("ra", "sto", "ti", "n") for c in ("", "l", "x", "ne")]


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, a chain of near copies, empties, nulls, ties and a long one."""
    r = random.Random(7)
    base = [[r.choice(WORDS) for _ in range(r.randint(5, 120))] for _ in range(40)]
    out = [" ".join(w) for w in base]
    out += [out[0], out[0].upper(), f"  {out[1]}\n", out[2].replace(" ", "\t")]
    for i in range(8):  # each differs from the one before by a few words at another place
        w = base[3] * 3
        for j in range(i):
            w[20 * j % len(w)] = f"edit{j}"
        out.append(" ".join(w))
    out += ["", None, " \n\t ", None, "one", "ONE", "one two three", "one two three four", " ".join(r.choice(WORDS) for _ in range(20_000)), "İK é ß x y KK"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with extra columns whose names operators use inside, and a row that is there twice."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), i, "x") for i, t in enumerate(texts)]
    rows.append(rows[5])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, rep string").withColumnRenamed("rep", "gone").repartition(5).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def thue_morse(n):
    """The first n letters of the Thue-Morse word, and the same with a and b exchanged: polynomial hashes modulo 2^64 are equal."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))
