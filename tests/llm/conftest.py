import pytest

#: Names that operators use inside, and others that could clash with results.
CLASH = {"row": "x", "doc": 1, "ver": 2, "score": 0.5, "ids": "y", "key": "z", "host": "h", "first": 3}


@pytest.fixture(scope="session")
def make_docs(spark):
    """rows (doc_id, text) -> a documents table with nulls and clashing columns."""

    def make(rows, clash=True):
        extra = tuple(CLASH.values()) if clash else ()
        names = ", ".join(f"`{k}` {({str: 'string', int: 'long', float: 'double'})[type(v)]}" for k, v in CLASH.items()) if clash else ""
        schema = "doc_id long, text string, lang string, source string, n_chars long" + (", " + names if names else "")
        return spark.createDataFrame([(i, t, None, None, len(t) if t is not None else None, *extra) for i, t in rows], schema)

    return make


LONG = " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(
        [(None, "a null id. with some text"), (1, None), (2, ""), (3, " \n\t\n"), (4, "one"), (4, "one"), (5, "other text"), (5, "same id, other text"), (6, LONG), (7, LONG)]
    )
