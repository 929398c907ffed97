"""Byte-level BPE by prefix dynamic programming: each prefix of a piece has one valid last token."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Mapping
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAIRS_KEPT, PIECES_KEPT, PIECE_LENGTH_KEPT = 1 << 18, 1 << 18, 24
TEXT_AT_ONCE, MATCHES_AT_ONCE, BATCH_BYTES = 1 << 18, 1 << 16, 1 << 23


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of `base64 rank` lines; its size is that of a vocabulary."""
    try:
        with open(path, "rb") as lines:
            rows = [line.split() for line in lines]
    except FileNotFoundError:  # not on this machine: a store that Spark reads
        rows = [row.value.split() for row in spark.read.text(path).toLocalIterator()]
    return {base64.b64decode(row[0]): int(row[1]) for row in rows if row}


def merge_bytes(ranks: Mapping[bytes, int], data: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
    """Plain merging, lowest rank first, leftmost among equals: what is left, and the last pair merged."""
    parts, last = [data[i : i + 1] for i in range(len(data))], None
    while len(parts) > 1:
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        known = [(rank, i) for i, rank in enumerate(pairs) if rank is not None]
        if not known:
            break
        _, i = min(known)
        last = parts[i], parts[i + 1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


def token_halves(ranks: Mapping[bytes, int]) -> dict[int, tuple[int, int] | None]:
    """Each token's rank and the ranks of the two tokens it is merged from; None for a single byte.

    Tokens that merging never makes of their own bytes are left out: they stand for a whole piece only.
    """
    halves: dict[int, tuple[int, int] | None] = {}
    for token, rank in sorted(ranks.items(), key=lambda row: row[1]):
        parts, last = merge_bytes(ranks, token)
        if len(parts) == 1:
            halves[rank] = last and (ranks[last[0]], ranks[last[1]])
            if last and max(halves[rank]) > rank:
                raise ValueError("a token ranks before its halves: not a vocabulary of merges")
    return halves


class PrefixEncoder:
    """Tokens by rank, and which token may follow which.

    A sequence of tokens is what merging makes of its bytes exactly if each pair of neighbours is what
    merging makes of the pair's own bytes. So a prefix that ends with token t has the encoding of the
    prefix before t and then t, and only one t fits: its last token.

    Whether a pair stays a pair is read off the tokens at the border. While the left token is built,
    the part at its right end grows from a byte to the token, each at its rank; likewise the part at
    the left end of the right token. The border is crossed if two parts that stand there at the same
    time make a token that comes before the next growth of both (on equal ranks the leftmost pair
    merges first: the left token's own growth before the border, the border before the right one's).
    """

    def __init__(self, ranks: Mapping[bytes, int], halves: Mapping[int, tuple[int, int] | None] | None = None):
        import ahocorasick

        absent = [b for b in range(256) if bytes([b]) not in ranks]
        if absent:
            raise ValueError(f"the vocabulary lacks single bytes: {absent[:5]}")
        self.ranks = ranks
        self.halves = token_halves(ranks) if halves is None else halves
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.ends = ahocorasick.Automaton()
        for rank in self.halves:
            token = self.token_bytes[rank]
            self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()
        self._edges: tuple[dict, dict] = {}, {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at the left (0) or right (1) end of a token as it is built, and their ranks."""
        found = self._edges[side].get(token)
        if found is None:
            half = self.halves[token]
            found = [*(self._edge(half[side], side) if half else ()), (self.token_bytes[token], token)]
            self._edges[side][token] = found
        return found

    def fits(self, before: int, token: int) -> bool:
        """True if `token` may follow `before`; -1 stands for the start of the piece."""
        found = before < 0 or not self._crossed(self._edge(before, 1), self._edge(token, 0))
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[before, token] = found
        return found

    def _crossed(self, left: list[tuple[bytes, int]], right: list[tuple[bytes, int]]) -> bool:
        i = j = 0
        never = len(self.ranks) + max(left[-1][1], right[-1][1]) + 1
        while True:
            grow_left = left[i + 1][1] if i + 1 < len(left) else never
            grow_right = right[j + 1][1] if j + 1 < len(right) else never
            rank = self.ranks.get(left[i][0] + right[j][0])
            if rank is not None and rank < grow_left and rank <= grow_right:
                return True
            if grow_left == grow_right == never:
                return False
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def piece(self, data: bytes) -> list[int]:
        """The tokens of one match of the pattern: itself if it is a token, else the merged ones."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else Prefixes(self, data).tokens()


class Prefixes:
    """The last token of every prefix of a byte string that may grow and be edited."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", array("q", [-1])
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; no prefix seen before is computed again."""
        start = len(self.data)
        self.data += more
        self._fill(start)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put `new` in place of data[start:stop]; returns how many prefixes were computed.

        Prefixes up to `start` stay. Behind the new bytes a prefix depends on those at most one longest
        token before it: when that many in a row have the last tokens they had, the rest is as it was.
        """
        before, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = before[: start + 1]
        return self._fill(start, known=before, shift=shift, settled=start + len(new))

    def tokens(self) -> list[int]:
        """The encoding, read from the end."""
        out, at, sizes = [], len(self.data), self.encoder.token_bytes
        while at:
            out.append(self.last[at])
            at -= len(sizes[out[-1]])
        return out[::-1]

    def _fill(self, start: int, known: array | None = None, shift: int = 0, settled: int = 0) -> int:
        encoder, last, same, filled = self.encoder, self.last, 0, start
        pairs, fits = encoder.pairs, encoder.fits
        text = self.data.decode("latin-1")
        for end, (token, size) in encoder.ends.iter(text, max(0, start + 1 - encoder.longest)):
            if end < filled:
                continue
            before = last[end + 1 - size]
            ok = pairs.get((before, token))
            if not (fits(before, token) if ok is None else ok):
                continue
            last.append(token)
            filled = end + 1
            if known is not None and filled >= settled:
                same = same + 1 if known[filled - shift] == token else 0
                if same >= encoder.longest:
                    last.extend(known[filled - shift + 1 :])
                    return filled - start
        return len(self.data) - start


class _Pieces(dict):
    """Encoded pieces, remembered; long ones, which seldom come again, in `long` until a block ends."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder, self.long = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.long.get(piece)
        if found is None:
            found = array("I", self.encoder.piece(piece.encode())).tobytes()
            (self if len(piece) <= PIECE_LENGTH_KEPT else self.long)[piece] = found
        return found


class TextEncoder:
    """Whole texts: split by the pattern, each match encoded on its own, short ones remembered."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str, halves: Mapping[int, tuple[int, int] | None] | None = None):
        import regex

        # White space is the Unicode property, as for the tokenizers that use this pattern; the
        # separators 1C to 1F are not in it.
        space = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.split = regex.compile(space.replace(r"\S", r"\P{White_Space}"))
        self.pieces = PrefixEncoder(ranks, halves)
        self._known = _Pieces(self.pieces)

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers, the layout of token files."""
        out, known = [], self._known
        for block in self._blocks(text):
            out.append(b"".join(map(known.__getitem__, block)))
            known.long.clear()
            if len(known) > PIECES_KEPT:
                known.clear()
        return b"".join(out)

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The matches; those of a very long text in blocks, so that they never stand in memory at once."""
        if len(text) <= TEXT_AT_ONCE:
            yield self.split.findall(text)
            return
        matches = self.split.finditer(text)
        while block := [m.group() for m in islice(matches, MATCHES_AT_ONCE)]:
            yield block

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.token_bytes.__getitem__, array("I", ids)))


def _in_pieces(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few megabytes, however long their texts are."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes)) + 64
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def encode_texts(
    docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: key, n_tokens and ids, the token ids as little-endian unsigned 32-bit integers.

    Each match of `pattern` is encoded on its own; there are no special tokens. Documents go through
    row by row in narrow tasks: no shuffle, and memory holds the vocabulary (broadcast: a rank file of
    fixed size), one batch, and remembered pieces and pairs up to a fixed number. A text is split in
    blocks of matches, so a very long one needs memory for its own length only; a single match of any
    length takes time in proportion to it.

    Null text is empty, and empty text has 0 tokens and empty ids. Repeated rows and rows with a null
    key stay, each with its own result. An empty table gives no rows. Extra columns are ignored,
    whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast((dict(ranks), token_halves(ranks)))
    schema = pa.schema([("k", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = None
        for batch in batches:
            encoder = encoder or TextEncoder(shared.value[0], pattern, shared.value[1])
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(t.as_py() or "")
                yield k, len(ids) // 4, ids

    given = docs.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").alias("t"))
    out = given.mapInArrow(lambda b: _in_pieces(rows(b), schema), "k string, n_tokens long, ids binary")
    return out.select(F.col("k").cast(docs.schema[key].dataType).alias(key), "n_tokens", "ids")


def decode_ids(encoded: DataFrame, ranks: Mapping[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; all given columns stay, one named `name` is replaced.

    Null ids decode to null, empty ids to no bytes. An id outside the vocabulary is an error. Ids of
    any length are decoded whole; repeated rows stay; an empty table gives no rows.
    """
    shared = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            words = shared.value
            found = (None if v is None else b"".join(map(words.__getitem__, array("I", v))) for v in column.to_pylist())
            yield pa.array(list(found), pa.binary())

    # Annotations are read when the function is made, so they need the names themselves.
    decode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return encoded.withColumn(name, F.arrow_udf(decode, "binary")(F.col(f"`{ids}`")))
