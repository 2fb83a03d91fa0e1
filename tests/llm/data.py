"""Small corpora with every awkward case."""

import random

LONG = " ".join(f"w{i}" for i in range(45))
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators might use themselves.
EXTRA = PLAIN + ", bin int, shard int, slot long, spans string, component_id long, train boolean, key string, words string, _id long, score string, _score double, hash long, node long, rep long, label string"


def awkward(seed: int = 3) -> list[tuple]:
    """(doc_id, text): nulls, empties, white space, copies, near copies, shared passages, repeats, very long, strange characters."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    base = text(120)
    words = base.split()
    near = [" ".join(w if j != k else "changed" for j, w in enumerate(words)) for k in (5, 60, 61, 119)]
    far = " ".join(w if j % 9 else "x" for j, w in enumerate(words))
    passage = text(50)
    docs = [None, "", " ", "\n\t ", "one", "ONE", "one two three", "one two three", "Ünï 中文 é\x85x 🙂", "<|endoftext|> a", base, base, base.upper(), *near, far]
    docs += [text(60) + " " + passage + " " + text(40), passage, text(10) + "\n" + passage, "again " * 100, "again " * 35, LONG, text(8000), text(34), text(35)]
    docs += [text(rnd.randint(1, 200)) for _ in range(40)]
    return list(enumerate(docs))


def frame(spark, rows, extra: bool = False):
    full = [(i, t, ("en", "fr")[(i or 0) % 2], "s", None) for i, t in rows]
    if extra:
        return spark.createDataFrame([(*r, 1, 2, 3, "s", 4, True, "k", "w", 5, "z", 0.5, 6, 7, 8, "l") for r in full], EXTRA)
    return spark.createDataFrame(full, PLAIN)


def tables(spark, path, rows, labels=(), items=(), extra: bool = False) -> str:
    """Writes a folder that the queries can read."""
    frame(spark, rows, extra).coalesce(2).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").coalesce(1).write.mode("overwrite").parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    return str(path)
