import pytest

TEXTS = [
    None,
    "",
    " \t\n ",
    "one two three four five six seven eight nine ten eleven twelve",
    "One two three four five six seven eight nine ten eleven TWELVE",
    "one two three four five six seven eight nine ten eleven thirteen",
    "word",
    "word",
    "  word ",
    "two words",
    "É é Ünder ß ñandú <|im_start|> < | <\\| end",
]


def long_texts():
    """Copies, near copies, shared passages, and a long text without blanks."""
    base = [f"w{i * 7 % 101}x{i % 13}" for i in range(160)]
    passage = [f"p{i}" for i in range(30)]
    out = []
    for k in range(12):
        own = list(base)
        for j in range(k):
            own[(j * 37 + k * 11) % 160] = f"edit{k}y{j}"
        out.append(" ".join(own))
    for k in range(6):
        own = [f"u{k}v{i}" for i in range(40)]
        out.append(" ".join(own[:20] + passage + own[20:]))
    out += [out[0], out[3], "a" * 30_000, " ".join(["same"] * 300), "\n".join(["Line one here."] * 5)]
    return out


@pytest.fixture(scope="session")
def rows():
    """doc_id, text: distinct ids, hostile texts."""
    return list(enumerate(TEXTS + long_texts()))


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns that clash with the operators' own names."""
    found = [
        (d, t, "en", (None, "b", "a", "ä")[d % 4], len(t or ""), d, "x", 1.5, "y", d)
        for d, t in rows
    ]
    return spark.createDataFrame(
        found,
        "doc_id long, text string, lang string, source string, n_chars long,"
        " size long, key string, score double, row string, hash long",
    )


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def repeated(docs):
    """Every row twice, and rows without an id."""
    nameless = docs.selectExpr(
        "cast(null as long) as doc_id", *[c for c in docs.columns if c != "doc_id"]
    ).filter("text is null or length(text) < 60")
    return docs.union(docs).union(nameless)
