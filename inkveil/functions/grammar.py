"""Grammar of nominatives, as regular expressions for Spark's `rlike`/`regexp_*`.

A *word* is a maximal run of letters. Names of people are words (possibly glued by
apostrophes) separated by white space, so no match ever holds any other character;
operators rely on this to cut texts safely.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
# Letters beyond A-Z that count as part of a name.
EXTRA_LETTERS = (
    "ĿŀČčŘřŠšŽžĲĳŒœŸŐőŰűḂḃĊċḊḋḞḟĠġṀṁṠṡṪṫĀāĒēĪīŌōŪūİıĞğŞşẀẁẂẃŴŵŶŷǾǿẞ"
)
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ" + EXTRA_LETTERS
APOSTROPHES = "'‘’′´`"
# Particles that may stand in front of a surname (any case).
PARTICLES = (
    "d((a|e)(l(l[aeo]?)?|i|gli?)?|i)?|(ne|a|su)(l(l[aeo]?)?|i|gli)?"
    "|l[aeo]?|co[iln]?|i[ln]?|gli|per"
)
# A list line: optional "!", one to ten names, a surname.
LIST_LINE = (
    f"^(!)?([{LETTERS}{APOSTROPHES}]+:){{0,9}}[{LETTERS}{APOSTROPHES}]+;"
    f"[{LETTERS}{APOSTROPHES}\\s]+$"
)
# Expressions which look like nominatives but are never replaced.
DEFAULT_KEEP_EXPRESSIONS = (
    "Al Sindaco",
    "Il Sindaco",
    "Il Sottoscritto",
    "La Sottoscritta",
    "Al Sottoscritto",
    "Alla Sottoscritta",
)
MAX_NAMES = 10
# ----------------------------------------------------------------------------------



def _ranges(chars: str) -> str:
    """Characters as ranges of neighbours."""
    spans: list[list[str]] = []
    for c in sorted(set(chars)):
        if spans and ord(c) == ord(spans[-1][1]) + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "".join(a if a == b else f"{a}-{b}" for a, b in spans)


# The same letters for use in a character class. Java tries the members of a class one
# by one; kept behind one range test, the rare letters cost nothing on ASCII text.
LETTER = f"A-Za-z[À-ẞ&&[À-ÖØ-öø-ÿ{_ranges(EXTRA_LETTERS)}]]"

NOT_AFTER_LETTER = f"(?<![{LETTER}])"
NOT_BEFORE_LETTER = f"(?![{LETTER}])"
WORD = f"[{LETTER}]+"
NAME = f"[A-Z][{LETTER}]+"
GLUE = f"[{APOSTROPHES}\\s]+"
SURNAME_PREFIX = f"(?:[A-Z][{LETTER}]*|(?i:{PARTICLES})){GLUE}"
SURNAME = f"(?:{SURNAME_PREFIX})?{NAME}"

# Is there a nominative at all?  "Name Surname" and "Surname Name" with their optional
# parts dropped come down to a capitalised word, white space, an optional surname
# prefix and a second capitalised word.
GATE = f"{NOT_AFTER_LETTER}{NAME}\\s+(?:{SURNAME_PREFIX})?[A-Z][{LETTER}]"

# A stretch of text a match can lie in: any words ...
STRETCH = f"[{LETTER}][{LETTER}{APOSTROPHES}\\s]*"
# ... or, if every first name looked for is a capitalised word, only capitalised
# words and particles.
_CAPITAL_WORD = f"{NOT_AFTER_LETTER}(?:[A-Z][{LETTER}]*|(?i:{PARTICLES})){NOT_BEFORE_LETTER}"
CAPITAL_STRETCH = f"{_CAPITAL_WORD}(?:{GLUE}{_CAPITAL_WORD})+"

# A text node ending like this may be followed by part of the same name.
OPEN_END = f"[{LETTER}{APOSTROPHES}\\s]$"


def is_name_like(text: Column) -> Column:
    """Does the block hold anything that reads like a nominative?"""
    return text.rlike(GATE)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def quoted(text: Column) -> Column:
    return F.concat(F.lit("\\Q"), text, F.lit("\\E"))


def _rest(text: Column) -> Column:
    return F.substring(text, 2, 1 << 30)


def term_pattern(term: Column) -> Column:
    """First letter as listed, the rest in any (ASCII) case."""
    return F.concat(
        quoted(F.substring(term, 1, 1)), F.lit("(?i:"), quoted(_rest(term)), F.lit(")")
    )


def surname_pattern(surname: Column) -> Column:
    """Any apostrophe matches any other, with an optional blank after it; a
    surname that starts in lower case is matched in any case throughout."""
    apostrophe = f"[{APOSTROPHES}]"
    tolerant = F.array_join(
        F.transform(F.split(surname, apostrophe, -1), quoted), f"{apostrophe} ?"
    )
    first = F.substring(surname, 1, 1)
    tail = F.array_join(
        F.transform(F.split(_rest(surname), apostrophe, -1), quoted), f"{apostrophe} ?"
    )
    return F.when(
        first.rlike("^\\p{Lu}"),
        F.concat(quoted(first), F.lit("(?i:"), tail, F.lit(")")),
    ).otherwise(F.concat(F.lit("(?i:"), tolerant, F.lit(")")))


def person_pattern(names: Column, surname: Column, all_names: Column) -> Column:
    """The pattern of a listed person.

    Names stand before or after the surname, in any order, each at most once: an
    alternative is closed by a negative look-ahead on its own back-reference once its
    group has matched, which spares writing out the permutations of up to ten names.
    `all_names` (homonyms) asks for every name instead of at least one.

    Java reads a number of two digits as a back-reference only behind the group it names.
    From the tenth group on, a name is therefore taken by a loop of two rounds: the second
    one sets an empty group, which stands before the look-ahead of the first.
    """
    count = F.size(names)

    def any_name(offset: Column) -> Column:
        def once(name: Column, i: Column) -> Column:
            term, number = term_pattern(name), i + 1 + offset
            unused = F.concat(F.lit("(?!(?i:\\"), number.cast("string"), F.lit("))"))
            near = F.concat(unused, F.lit("("), term, F.lit(")"))
            far = F.concat(
                F.lit("(?="), term, F.lit(")(?:(?<="), term, F.lit(")()|(?!\\"),
                number.cast("string"), F.lit(")"), term, F.lit("){2}"),
            )
            return F.when(number < 10, near).otherwise(far)

        return F.concat(F.lit("(?:"), F.array_join(F.transform(names, once), "|"), F.lit(")"))

    times = F.concat(
        F.lit("{"),
        F.when(all_names, count).otherwise(F.lit(1)).cast("string"),
        F.lit(","),
        count.cast("string"),
        F.lit("}"),
    )
    last = surname_pattern(surname)
    return F.concat(
        F.lit(f"{NOT_AFTER_LETTER}(?:(?:"),
        any_name(F.lit(0)), F.lit("\\s+)"), times, last,
        F.lit("|"),
        last, F.lit("(?:\\s+"), any_name(count), F.lit(")"), times,
        F.lit(f"){NOT_BEFORE_LETTER}"),
    )


def _dictionary(term: str, letter: str, capital: str) -> str:
    """A first name with an optional second name, before or after a surname."""
    name = f"[{capital}][{letter}]+"
    surname = f"(?:(?:[{capital}][{letter}]*|(?i:{PARTICLES})){GLUE})?{name}"
    given = f"(?:{term}(?:\\s+{name})?|(?:{name}\\s+)?{term})"
    return f"(?<![{letter}])(?:{given}\\s+{surname}|{surname}\\s+{given})(?![{letter}])"


# Stands for the first letter of a word equal to the dictionary name looked for.
NAME_MARK = "\ufdd4"
# One pattern for all names that are a single capitalised word, on marked text.
MARKED_NAME = _dictionary(
    f"{NAME_MARK}[{LETTER}]*", LETTER + NAME_MARK, "A-Z" + NAME_MARK
)
PLAIN_WORD = f"^[A-Z][{LETTER}]*$"


def dictionary_pattern(name: Column) -> Column:
    """O33, O34 for any dictionary name."""
    term = term_pattern(name)
    slot = "\ufdd5"
    around = _dictionary(slot, LETTER, "A-Z").split(slot)
    pieces: list[Column] = [F.lit(around[0])]
    for text in around[1:]:
        pieces += [term, F.lit(text)]
    return F.concat(*pieces)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mark_name(text: Column, name: Column) -> Column:
    """Put the mark in place of the first letter of every word equal to `name`, first
    letter as listed, the rest in any (ASCII) case."""

    def same(word: Column) -> Column:
        return (F.lower(word) == F.lower(name)) & (
            F.concat(F.substring(word, 1, 1), ascii_lower(_rest(word)))
            == F.concat(F.substring(name, 1, 1), ascii_lower(_rest(name)))
        )

    tokens = F.regexp_extract_all(text, F.lit(f"(?s)[{LETTER}]+|."), F.lit(0))
    return F.array_join(
        F.transform(
            tokens,
            lambda t: F.when(same(t), F.concat(F.lit(NAME_MARK), _rest(t))).otherwise(t),
        ),
        "",
    )
