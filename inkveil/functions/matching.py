"""The search of one stretch of text in plain Python, for Arrow batches.

The same grammar and the same order of edits as `spans.resolve`, without an expression to
compile for each candidate: a person's names and surname are compared where words begin.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple
from unicodedata import category

from inkveil.functions import grammar, spans

_L = grammar.LETTERS
_WORDS = re.compile(f"([{_L}]+)([^{_L}]*)")
_WORD = re.compile(f"[{_L}]+")
_GLUE = re.compile(f"{grammar.GLUE}\\Z", re.ASCII)
_PARTICLE = re.compile(f"(?i:{grammar.PARTICLES})\\Z", re.ASCII)
# where a name or surname can begin
_BEGINS = re.compile(f"(?<![{_L}]).", re.DOTALL)
_LETTER = frozenset(c for c in map(chr, range(0x1E9F)) if re.match(f"[{_L}]", c))
_SPACE = " \t\n\x0b\f\r"
_APOSTROPHE = re.compile(f"[{grammar.APOSTROPHES}]")
_BETWEEN = _SPACE + grammar.APOSTROPHES

Span = tuple[int, int]


def translated(pattern: str) -> re.Pattern:
    """A pattern of `grammar` without back-references, for Python."""
    plain = re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), pattern, flags=re.DOTALL)
    return re.compile(plain.replace(grammar.LETTER, _L), re.ASCII)


_compiled = lru_cache(4096)(translated)
_MARKED = translated(grammar.MARKED_NAME)


@lru_cache(1 << 16)
def _fits_capital(word: str) -> bool:
    return "A" <= word[0] <= "Z" or _PARTICLE.match(word) is not None


@lru_cache(1 << 14)
def _is_glue(gap: str) -> bool:
    return _GLUE.match(gap) is not None


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def stretches(text: str, capital: bool) -> Iterator[tuple[int, int, list[str]]]:
    """`start, end, words` of the stretches of a text; `capital`: of capitalised words and
    particles only, two at least, else with all blanks and apostrophes behind the last word."""
    found = _WORDS.findall(text)
    at = len(text) - sum([len(w) + len(g) for w, g in found])
    first, last, held = 0, 0, []
    for word, gap in found:
        if not capital or _fits_capital(word):
            if not held:
                first = at
            held.append(word)
            last = at + len(word)
            if not capital:
                last += len(gap) - len(gap.lstrip(_BETWEEN))
            if gap and _is_glue(gap):
                at += len(word) + len(gap)
                continue
        if held:
            if len(held) > capital:
                yield first, last, held
            held = []
        at += len(word) + len(gap)
    if len(held) > capital:
        yield first, last, held


def keys_of(words: list[str], widths: tuple[int, ...]) -> set[str]:
    """Keys of all windows of adjacent words."""
    low = [w.lower() for w in words]
    keys: set[str] = set()
    for width in widths:
        if width == 1:
            keys.update(low)
        elif width == 2:
            keys.update([f"{a} {b}" if a <= b else f"{b} {a}" for a, b in pairwise(low)])
        else:
            some = range(len(low) - width + 1)
            keys.update([" ".join(sorted(low[i : i + width])) for i in some])
    return keys


class Entry(NamedTuple):
    """Who is looked for: a person by names and surname, a name of the dictionary by `mark` or
    `pattern`."""

    ord: int
    keep: bool
    pattern: str | None
    mark: str | None
    # first letter and the rest, in lower case
    names: list[tuple[str, str]]
    least: int
    # the first letter if its case counts, and what stands between apostrophes, in lower case
    surname: tuple[str, list[str]]
    # letters that a match can begin with; none: any
    first: str

    @classmethod
    def of(cls, ord, keep, pattern, mark, names, surname, full_only) -> Entry:
        if surname is None:
            return cls(ord, keep, pattern, mark, [], 0, ("", []), "")
        head = surname[0] if category(surname[0]) == "Lu" else ""
        parts = _APOSTROPHE.split(ascii_lower(surname[len(head) :]))
        terms = [(n[0], ascii_lower(n[1:])) for n in names]
        first = "".join([head, *[n for n, _ in terms]]) if head else ""
        least = len(terms) if full_only else 1
        return cls(ord, keep, None, None, terms, least, (head, parts), first)

    def matches(self, text: str) -> list[Span]:
        """All matches, leftmost first and not overlapping."""
        if self.mark is not None:
            return [m.span() for m in _MARKED.finditer(_marked(text, self.mark))]
        if self.pattern is not None:
            return [m.span() for m in _compiled(self.pattern).finditer(text)]
        found, done, low = [], 0, ascii_lower(text)
        for match in _BEGINS.finditer(text):
            begin = match.start()
            if begin < done or (self.first and match[0] not in self.first):
                continue
            end = self._names_first(text, low, begin, ()) or self._surname_first(text, low, begin)
            if end:
                found.append((begin, end))
                done = end
        return found

    def _unused(self, text: str, low: str, at: int, used: tuple[int, ...]) -> Iterator[Span]:
        """Names not used yet that stand at a place, with their ends."""
        for k, (first, rest) in enumerate(self.names):
            if text.startswith(first, at) and low.startswith(rest, at + 1) and k not in used:
                yield k, at + 1 + len(rest)

    def _last(self, text: str, low: str, at: int) -> Iterator[int]:
        """Where the surname that stands at a place can end."""
        head, parts = self.surname
        return _tolerant(low, parts, at + len(head)) if text.startswith(head, at) else iter(())

    def _names_first(self, text: str, low: str, at: int, used: tuple[int, ...]) -> int | None:
        if len(used) < len(self.names):
            for k, end in self._unused(text, low, at, used):
                for after in _blanks(text, end):
                    found = self._names_first(text, low, after, (*used, k))
                    if found:
                        return found
        if len(used) >= self.least:
            for end in self._last(text, low, at):
                if text[end : end + 1] not in _LETTER:
                    return end
        return None

    def _surname_first(self, text: str, low: str, at: int) -> int | None:
        for end in self._last(text, low, at):
            found = self._names_last(text, low, end, ())
            if found:
                return found
        return None

    def _names_last(self, text: str, low: str, at: int, used: tuple[int, ...]) -> int | None:
        if len(used) < len(self.names):
            for after in _blanks(text, at):
                for k, end in self._unused(text, low, after, used):
                    found = self._names_last(text, low, end, (*used, k))
                    if found:
                        return found
        return at if len(used) >= self.least and text[at : at + 1] not in _LETTER else None


def _blanks(text: str, at: int) -> range:
    """Where one blank or more from a place on can end, the last place first."""
    end = at
    while text[end : end + 1] and text[end] in _SPACE:
        end += 1
    return range(end, at, -1)


def _tolerant(low: str, parts: list[str], at: int) -> Iterator[int]:
    """Any apostrophe stands for any other, with a blank after it or without."""
    if not low.startswith(parts[0], at):
        return
    at += len(parts[0])
    if len(parts) == 1:
        yield at
    elif low[at : at + 1] and low[at] in grammar.APOSTROPHES:
        if low.startswith(" ", at + 1):
            yield from _tolerant(low, parts[1:], at + 2)
        yield from _tolerant(low, parts[1:], at + 1)


def _marked(text: str, name: str) -> str:
    """The mark in place of the first letter of every word equal to a name."""
    first, rest = name[0], ascii_lower(name[1:])

    def mark(m: re.Match) -> str:
        word = m[0]
        same = word[0] == first and ascii_lower(word[1:]) == rest
        return grammar.NAME_MARK + word[1:] if same else word

    return _WORD.sub(mark, text)


@lru_cache(16)
def _ahead(literals: tuple[str, ...]) -> re.Pattern:
    return re.compile(f"(?=({'|'.join(map(re.escape, literals))}))")


def locate(text: str, literals: tuple[str, ...]) -> list[Span]:
    """At each place the first of the literals that starts there."""
    if not any([x in text for x in literals]):
        return []
    return [m.span(1) for m in _ahead(literals).finditer(text)]


def touches(a: Span, b: Span, rule: str = "overlap") -> bool:
    """As `spans.touches`: does the kept span `b` protect the match `a`?"""
    if rule == "overlap":
        return b[0] < a[1] and a[0] < b[1]
    return b[0] <= a[0] < b[1] or b[0] < a[1] <= b[1]


Found = tuple[int, int, int, str]


def resolve(
    text: str, entries: list[Entry], kept: list[Span], rule: str, report_kept: bool, shadowed: bool
) -> list[Found]:
    """As `spans.resolve`, and with `shadowed` also `spans.with_shadowed`."""
    found: list[Found] = []
    kept, now = list(kept), text
    for entry in entries:
        some = entry.matches(now)
        if entry.keep:
            kept += some
            if report_kept:
                found += [(b, e, entry.ord, "kept") for b, e in some]
            continue
        for span in some:
            held = any(touches(span, k, rule) for k in kept)
            found.append((*span, entry.ord, "protected" if held else "replaced"))
            if not held:
                now = now[: span[0]] + spans.BLANK * (span[1] - span[0]) + now[span[1] :]
    if shadowed and len(entries) > 1:
        won = [f for f in found if f[3] == "replaced"]
        for entry in entries:
            if not entry.keep and any(f[2] < entry.ord for f in won):
                found += [
                    (*m, entry.ord, "shadowed")
                    for m in entry.matches(text)
                    if any(f[2] < entry.ord and touches(m, f) for f in won)
                ]
    found.sort()
    return found


def shifted(found: list[Found], by: int) -> list[Found]:
    return [(b + by, e + by, ord, status) for b, e, ord, status in found]
