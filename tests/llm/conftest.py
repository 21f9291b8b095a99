import pytest

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, "
    "toxic int, row string, fp string, hits string, found string, epoch string, Block string, "
    "n_words int, kept string, place string, print string, mix_full string"
)
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box and hum".split()


def sentence(seed, n=30):
    return " ".join(WORDS[(seed * (k + 3) + k * k) % len(WORDS)] for k in range(n)) + "."


LONG = "\n".join(sentence(k, 40) for k in range(9000))
TEXTS = [
    None, "", "   \n\t ", "12345 ??", sentence(1), sentence(1), sentence(2), sentence(3) + " extra",
    sentence(3), "one\n\n", "Ünïcode strasse ñandú 日本語 😀 end.\nsecond line of the text\n",
    "second line of the text\nSECOND LINE OF THE TEXT  \nother", LONG,
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing columns."""
    extra = (None,) * 13
    rows = [(k, t, "en" if k % 2 else None, f"s{k % 3}", 1, *extra) for k, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (6, "same id, other text", "en", None, None, *extra)]
    rows += [(None, sentence(1), None, None, None, *extra), (None, None, None, None, None, *extra)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


def plain(rows):
    return sorted(map(repr, rows))
