"""Small corpora with every odd case, and plain forms of the words."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, keys int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def texts(seed=0, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéñß", k=rng.randint(1, 6))) for _ in range(400)]
    say = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, base = say(70), say(120)
    out = [say(rng.randint(1, 150)) for _ in range(n)]
    out += [f"{say(30)} {passage} {say(20)}" for _ in range(5)] + [passage, f"{say(60)}\n{passage[:200]}"]
    for _ in range(8):  # near copies, further and further away
        words = base.split()
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append("  ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
    out += [base] * 4 + ["a b a b " * 60, "word " * 300, "one", "two words", "three little words", "three little words", "Three  LITTLE\twords"]
    out += [None, "", "   \n\t ", "!!! ... ???", "\x1c \x1d|\x0b\x0c", "x" * 3000, "éÉ ÉÉ     nbsp", "日本語 テキスト 🙂", "don't we'll I'M it's 12 345 ½ ²"]
    return out


def rows(seed=0, n=60):
    """Shuffled ids with gaps; one id twice with its text, one with another text, one missing."""
    own = texts(seed, n)
    ids = random.Random(seed + 1).sample(range(3 * len(own)), len(own))
    out = [(i, t, ("en", "de", None)[i % 3], None if i % 5 else "s", None if t is None else len(t), "clash", i) for i, t in zip(ids, own, strict=True)]
    out += [out[5], out[-1], (None, own[3], None, None, None, None, None)]
    return out


def docs(spark, seed=0, n=60, parts=5):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_rows(df):
    return sorted(map(repr, map(tuple, df.collect())))
