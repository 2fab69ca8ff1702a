import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, wordless, short, very long, equal and near-equal texts, a repeated row, and columns named as operators name theirs."""
    base = " ".join(f"word{k % 97}x{k // 97}" for k in range(300))
    near = base.replace("word5x0", "changed")
    texts = [None, "", "!!! ...", "Short", "short", base, near, base, "é " * 40 + base, "long " + " ".join(f"t{k}" for k in range(30_000)), "tab\tnew\nline\x00nul ▁ 😀", "  spaces   inside  "]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows.append(rows[5])
    df = spark.createDataFrame(rows, DOCS)
    clash = ["score", "kept", "spans", "items", "cleaned", "shard", "slot", "class_id", "ids", "_id", "node", "fingerprint", "k0", "_t"]
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("own") for c in clash})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
