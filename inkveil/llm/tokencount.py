"""Token counts by a tokenizer compiled to a finite-state transducer.

Byte-pair encoding of a word is decided from left to right: after each symbol the prefix read
so far has one last token, which is the only token that ends there and is compatible with the
last token of the prefix before it (two tokens are compatible if their own text is encoded as
just these two). What matters of a prefix is finite: its last token, and for each place where
a token may still be open, the tree node reached, the token before and how many tokens were
emitted since. Such a configuration is a state; a transition is annotated with the number of
tokens that it adds. States and transitions are determinised when first met and kept in
tables of bounded size.

A text is cut into chunks. The map of a chunk (from the state before to the state after it,
with a count) is known outright once the chunk holds a blank: what stands before the first
one waits for its state, what stands after the last one is the state. Maps compose
associatively, so chunks are counted anywhere in the cluster and combined by a prefix scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import resident



LIMIT = 2048
#: Code points of a chunk.
CHUNK = 1 << 18
#: Bounds of a worker's tables; a full table is begun anew.
STATES, PIECES = 120_000, 150_000

# letters that no normaliser joins or parts, and signs that stand alone between them
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_SIGNS = re.compile(r"[.,]?\n|[.,]")

Map = tuple[str, int, str, bool]


class Transducer:
    """Counts the tokens of words (strings of the tokenizer's own alphabet)."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str) -> None:
        self.end = end
        self.ranks = {pair: k for k, pair in enumerate(merges)}
        # symbols are characters; the last of a word carries the end mark and is a symbol too
        self.tree: list[dict[str, int]] = [{}]
        self.token_at: dict[int, str] = {}
        # the two tokens of the merge that makes a token
        self.halves: dict[str, tuple[str, str]] = {}
        for token in vocabulary:
            symbols = self.symbols(token)
            parts, last = self.merged(symbols)
            if len(parts) > 1:  # never the encoding of its own text
                continue
            if last:
                self.halves[token] = last
            node = 0
            for s in symbols:
                nodes = self.tree[node]
                if s not in nodes:
                    nodes[s] = len(self.tree)
                    self.tree.append({})
                node = nodes[s]
            self.token_at[node] = token
        self.edges: tuple[dict, dict] = ({}, {})
        self.clear()

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at the left (0) or right (1) edge of a token while it is put together,
        and the rank of the merge that ends it."""
        found = self.edges[side].get(token)
        if found is None:
            found, until, part = [], len(self.ranks), token
            while part in self.halves:
                found.append((part, until))
                until = self.ranks[self.halves[part]]
                part = self.halves[part][side]
            found.append((part, until))
            self.edges[side][token] = found
        return found

    def clear(self) -> None:
        # a state: the open places, as (tree node, token before, tokens since)
        start = ((0, None, 0),)
        self.states: list[tuple] = [start]
        self.numbers: dict[tuple, int] = {start: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}

    def symbols(self, token: str) -> tuple[str, ...]:
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return (*body[:-1], body[-1] + self.end)
        return tuple(token)

    def merged(self, symbols: tuple[str, ...]) -> tuple[list[str], tuple[str, str] | None]:
        """The encoding by definition (the pair of least rank is joined, leftmost first), and
        the last pair joined."""
        parts, last, none = list(symbols), None, len(self.ranks)
        while len(parts) > 1:
            rank, k = min((self.ranks.get(p, none), k) for k, p in enumerate(pairwise(parts)))
            if rank == none:
                break
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts, last

    def compatible(self, a: str | None, b: str) -> bool:
        """No merge joins what stands on both sides of the border while a and b are put together.

        Equal pairs are joined from the left, so the left neighbour's merge goes first.
        """
        if a is None:
            return True
        ranks, left = self.ranks, self.edge(b, 0)
        for x, x_until in self.edge(a, 1):
            for y, y_until in left:
                rank = ranks.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
        return True

    def move(self, state: int, symbol: str) -> tuple[int, int]:
        """The next state and the number of tokens that a transition adds."""
        last, added, places, tree = None, None, [], self.tree
        for node, before, since in self.states[state]:
            node = tree[node].get(symbol)
            if node is None:
                continue
            token = self.token_at.get(node)
            if token is not None and added is None and self.compatible(before, token):
                last, added = token, 1 - since
            if tree[node]:
                places.append((node, before, since))
        if added is None:
            raise KeyError(symbol)
        key = (*[(n, b, s + added) for n, b, s in places], (0, last, 0))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        self.moves[state, symbol] = found = (number, added)
        return found

    def count(self, word: str) -> int:
        if len(self.states) >= STATES:
            self.clear()
        state = total = 0
        moves = self.moves
        for symbol in word[:-1]:
            state, added = moves.get((state, symbol)) or self.move(state, symbol)
            total += added
        symbol = word[-1] + self.end
        return total + (moves.get((state, symbol)) or self.move(state, symbol))[1]


def _alphabet() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Counter:
    """Maps of chunks for one tokenizer file: lower-cased words, white space dropped."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.library = Tokenizer.from_file(path)
        self.transducer = Transducer(
            model["vocab"], merges, model.get("end_of_word_suffix") or ""
        )
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if not all(s.startswith("<") and " " not in s for s in special):
            raise ValueError("special strings begin with < and hold no blank")
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.pieces: dict[str, int] = {}
        self.known: dict[str, int] = {}

    def words(self, piece: str) -> list[str]:
        """The words that the tokenizer's normaliser and splitter make of a piece.

        Letters with simple signs or a line break after them are taken apart here, all else
        by the library.
        """
        low = piece.lower()
        parts = _SIGNS.split(low)
        if all(map(_LETTERS.fullmatch, parts if parts[-1] else parts[:-1])):
            marks = [s for s in (m.strip() for m in _SIGNS.findall(low)) if s]
            return [
                w if w.isascii() else w.encode().decode("latin-1").translate(_ALPHABET)
                for w in [*filter(None, parts), *marks]
            ]
        return [
            w
            for w, _ in self.library.pre_tokenizer.pre_tokenize_str(
                self.library.normalizer.normalize_str(piece)
            )
        ]

    def piece(self, piece: str) -> int:
        """Tokens of a stretch without blanks."""
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            found = 0
            for part in self.special.split(piece) if "<" in piece else [piece]:
                for word in self.words(part):
                    n = self.known.get(word)
                    if n is None:
                        n = self.transducer.count(word)
                        if len(self.known) >= PIECES:
                            self.known.clear()
                        if len(word) <= 64:
                            self.known[word] = n
                    found += n
            if "<" in piece:
                found += len(self.special.findall(piece))
            if len(piece) <= 64:
                self.pieces[piece] = found
        return found

    def map(self, chunk: str) -> Map:
        """(before the first blank, tokens up to the last, after it, whether there is one)."""
        head, blank, rest = chunk.partition(" ")
        if not blank:
            return chunk, 0, "", False
        body, _, tail = rest.rpartition(" ")
        known, total = self.pieces, 0
        for piece in body.split(" "):
            n = known.get(piece)
            total += self.piece(piece) if n is None else n
        return head, total, tail, True

    def compose(self, a: Map, b: Map) -> Map:
        """The map of two chunks in a row; associative."""
        if not a[3]:
            return a[0] + b[0], b[1], b[2], b[3]
        if not b[3]:
            return a[0], a[1], a[2] + b[0], True
        return a[0], a[1] + self.piece(a[2] + b[0]) + b[1], b[2], True

    def closed(self, part: Map, first: bool, last: bool) -> Map:
        """The map of a chunk at an end of the text: what is beyond it is known there."""
        head, n, tail, cut = part
        if not cut:
            return ("", self.piece(head), "", True) if first and last else part
        if first:
            head, n = "", n + self.piece(head)
        if last:
            tail, n = "", n + self.piece(tail)
        return head, n, tail, True

    def total(self, whole: Map) -> int:
        """The count of a whole text."""
        return self.closed(whole, True, True)[1]


_ALPHABET = _alphabet()


def loaded(path: str) -> Counter:
    return resident(f"count {path}", lambda: Counter(path))


_MAP = pa.struct(
    [("head", pa.string()), ("n", pa.int64()), ("tail", pa.string()), ("cut", pa.bool_())]
)


def _mapped(path: Callable[[], str]) -> Callable[[Column, Column, Column], Column]:
    @F.arrow_udf("struct<head: string, n: long, tail: string, cut: boolean>")
    def run(chunks: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        counter, maps = loaded(path()), []
        for begin in range(0, len(chunks), 256):
            rows = (column.slice(begin, 256).to_pylist() for column in (chunks, first, last))
            maps += [counter.closed(counter.map(c), a, z) for c, a, z in zip(*rows, strict=True)]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_())
        return pa.StructArray.from_arrays(
            [pa.array([m[k] for m in maps], t) for k, t in enumerate(kinds)],
            names=["head", "n", "tail", "cut"],
        )

    return run


def _composed(path: Callable[[], str]) -> Callable[[Column], Column]:
    @F.arrow_udf("long")
    def run(maps: pa.Array) -> pa.Array:
        out = []
        for parts in maps.to_pylist():
            parts = [(m["head"], m["n"], m["tail"], m["cut"]) for m in parts]
            if len(parts) == 1:  # both ends are counted
                out.append(parts[0][1])
            else:
                counter = loaded(path())
                out.append(counter.total(reduce(counter.compose, parts)))
        return pa.array(out, pa.int64())

    return run


def counted(
    docs: DataFrame,
    path: Callable[[], str],
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    limit: int = LIMIT,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, a row for each row of `docs`.

    Null and empty texts have no bytes and no tokens. Repeated rows are counted each for
    itself; null ids stay. An empty table gives an empty result; other columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    last = F.greatest(F.char_length(whole) - 1, F.lit(0))
    at = F.sequence(F.lit(0), F.floor(last / chunk).cast("int"))
    # rows are numbered before they are unfolded into chunks
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        whole.alias("text"),
        at.alias("places"),
    ).withColumn("at", F.explode("places"))
    maps = rows.select(
        "row",
        "doc_id",
        "n_bytes",
        "at",
        _mapped(path)(
            F.substring("text", F.col("at") * chunk + 1, F.lit(chunk)),
            F.col("at") == 0,
            F.col("at") == F.size("places") - 1,
        ).alias("map"),
    )
    whole_maps = maps.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("at", "map"))).alias("maps"),
    )
    counts = whole_maps.select(
        "doc_id",
        "n_bytes",
        _composed(path)(F.transform("maps", lambda m: m["map"])).alias("n_tokens"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
