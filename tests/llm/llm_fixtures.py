"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing names."""

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "row long, fingerprint long, score double, size long, task int, print long, prefix long")
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix vexing potions".split()


def text_of(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("," if x % 11 == 0 else ""))
    return " ".join(out)


def rows():
    texts = [(i, text_of(i, 5 + 3 * (i % 40))) for i in range(60)]
    texts += [(100 + i, text_of(1, 30)) for i in range(8)]                       # exact copies
    texts += [(200 + i, text_of(2, 60).upper() if i % 2 else text_of(2, 60)) for i in range(4)]
    texts += [(300, None), (301, ""), (302, "   \n\t "), (303, "one"), (304, "two words"), (None, "no id"), (None, None)]
    texts += [(400, text_of(9, 30000)), (401, "x" * 300000), (402, "é漢字🙂   naïve  \n \n  end")]  # long, and not ASCII
    texts += [(5, text_of(5, 20)), (5, text_of(5, 20)), (6, "another text of id six")]   # repeated ids and rows
    sources = ["a", "b", "c", "d", None, "é", "", "a", "a"]
    return [(i, t, None if k % 9 == 0 else "en", sources[k % 9], None if t is None else len(t),
             k % 3, 5, 0.25, None, 1, 2, 3) for k, (i, t) in enumerate(texts)]


def docs(spark):
    return spark.createDataFrame(rows(), DOC_SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def collected(df):
    return [r.asDict() for r in df.collect()]
