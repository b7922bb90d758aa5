"""Small tables with the awkward cases every operator must stand."""

import numpy as np

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "uid long, block long, value string, rep long, score double")


def words(rng, n, vocab=400):
    return " ".join(f"w{x}" for x in rng.zipf(1.3, n) % vocab)


def awkward_rows(n=120, seed=3):
    """Random texts, copies, near copies, nulls, empties, one long text, repeated rows."""
    rng = np.random.default_rng(seed)
    texts = [words(rng, int(rng.integers(1, 60))) for _ in range(n)]
    texts[7] = texts[3]
    texts[8] = texts[3]
    texts[11] = texts[10] + " tail"
    texts[20], texts[21], texts[22], texts[23] = None, "", "  \t\n", "one"
    texts[30] = words(rng, 9000)
    texts[31] = "Été É́ naïve don't <|endoftext|> 日本 x  y"
    rows = [(i, t, "en", "src0" if i % 3 else f"src{i % 7}", len(t or ""), 1, 2, "v", 3, 0.5)
            for i, t in enumerate(texts)]
    rows[40] = (40, texts[40], None, None, None, None, None, None, None, None)
    return rows + [rows[5], rows[5], (None, "no id here", "en", "src1", 3, 1, 2, "v", 3, 0.5)]


def docs(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOC_SCHEMA)
