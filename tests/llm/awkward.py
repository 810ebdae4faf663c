"""Documents with everything that should not break an operator."""

LINE = "This line of boilerplate stands in a great many of the documents here"
SHARED = " ".join(f"shared{i}" for i in range(60))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHES = ("id", "row", "body", "lines", "gone", "key", "pos", "salt", "n_lines", "score", "hits", "sig", "root", "size",
           "taken", "target", "range", "src", "label", "spans", "_")


def rows():
    out = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n ", "en", None, 4), (3, None, "en", "a", None)]
    out += [(10 + i, f"{LINE}\n{LINE.upper()} \nOwn words of number {i} " + " ".join(f"w{i}x{k}" for k in range(20 + 7 * i)),
             "en", "ab"[i % 2], 1) for i in range(9)]
    out += [(30, SHARED, "en", "a", 1), (31, f"before {SHARED} after", "de", "a", 1), (32, f"other {SHARED}", "fr", "Z", 1)]
    out += [(40, "word " * 30_000, "en", "long", 1), (41, "x" * 200_000, "en", "long", 1),
            (42, "\n".join(f"line {i} of a very long document without an end" for i in range(4000)), "en", "long", 1)]
    out += [out[5], out[5], (None, SHARED, "en", "é", 1)]
    return out


def documents(spark, kept=None):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([r for r in rows() if kept is None or kept(r)], COLUMNS)
    return df.withColumns({c: F.lit("taken") for c in CLASHES})


def unique(rows_):
    """Rows with an id, one per id."""
    return list({r[0]: r for r in rows_ if r[0] is not None}.values())
