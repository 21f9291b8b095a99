"""A plain-Python model of the search, one step after the other, to test against."""

import itertools
import re

from inkveil.functions.grammar import APOSTROPHES, LETTERS, PARTICLES

L = LETTERS
ANTE, POST = f"(?<![{L}])", f"(?![{L}])"
NAME = f"[A-Z][{L}]+"
GLUE = f"[{APOSTROPHES}\\s]+"
SURNAME = f"(?:(?:[A-Z][{L}]*|(?i:{PARTICLES})){GLUE})?{NAME}"
GATE = (
    f"{ANTE}(?:(?:{NAME}\\s+)?{NAME}\\s+{SURNAME}|{SURNAME}\\s+{NAME}(?:\\s+{NAME})?){POST}"
)
FLAGS = re.ASCII


def ci(term):
    return f"{re.escape(term[0])}(?i:{re.escape(term[1:])})"


def surname_pattern(surname):
    tolerant = re.sub(f"[{APOSTROPHES}]", f"[{APOSTROPHES}] ?", surname)
    if surname[0].isupper():
        return f"{tolerant[0]}(?i:{tolerant[1:]})"
    return f"(?i:{tolerant})"


def person_pattern(names, surname, all_names):
    sizes = [len(names)] if all_names else range(len(names), 0, -1)
    orders = [p for n in sizes for p in itertools.permutations(names, n)]
    given = "|".join("\\s+".join(ci(n) for n in order) for order in orders)
    last = surname_pattern(surname)
    return f"{ANTE}(?:(?:{given})\\s+{last}|{last}\\s+(?:{given})){POST}"


def dictionary_pattern(name):
    term = ci(name)
    given = f"(?:{term}(?:\\s+{NAME})?|(?:{NAME}\\s+)?{term})"
    return f"{ANTE}(?:{given}\\s+{SURNAME}|{SURNAME}\\s+{given}){POST}"


def homonyms(people):
    terms = [{t.upper() for t in [*names, surname]} for names, surname in people]
    return [
        any(terms[i] & terms[j] for j in range(len(people)) if j != i)
        for i in range(len(people))
    ]


def search(text, patterns, kept=(), rule="overlap"):
    """Spans `(start, end, number, status)`: each pattern in turn, leftmost first, on text
    not yet replaced."""
    if not re.search(GATE, text, FLAGS):
        return []
    found, masked = [], text
    for number, pattern in patterns:
        pos = 0
        while match := re.compile(pattern, FLAGS).search(masked, pos):
            a, b = match.span()
            if rule == "overlap":
                protected = any(x < b and a < y for x, y in kept)
            else:
                protected = any(x <= a < y or x < b <= y for x, y in kept)
            found.append((a, b, number, "protected" if protected else "replaced"))
            if not protected:
                masked = masked[:a] + "\0" * (b - a) + masked[b:]
            pos = b
    return sorted(found)


def literals(text, exprs):
    """Kept expressions: the longest one at each place where one starts."""
    out = []
    for i in range(len(text)):
        sizes = [len(e) for e in exprs if text.startswith(e, i)]
        if sizes:
            out.append((i, i + max(sizes)))
    return out


def assemble(nodes):
    """Blocks from `(family, action, text)`: `(texts, offsets of segments)`."""
    out, fresh, last = [], True, None
    for family, action, text in nodes:
        if action == "ignore":
            continue
        if action == "break":
            fresh = True
            continue
        if fresh or family != last:
            out.append(["", []])
        block = out[-1]
        block[1].append((len(block[0]), len(block[0]) + len(text)))
        block[0] += text
        fresh, last = False, family
    return out
