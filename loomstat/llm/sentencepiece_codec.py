"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The text is cut where no piece can reach across: before a run of word marks and around characters that occur in no
longer piece. Each cut is encoded by an agenda: a heap of adjacent symbol pairs, the best score first, the leftmost of
equal scores first; a pair whose symbols have changed since is skipped. Cuts repeat, so a task keeps a bounded table
of those it has encoded. Every new cut is also encoded by the sentencepiece library, all of an Arrow batch in one
call, and a difference stops the job.

Defined cases: a null text counts as empty; an empty text is the end id alone. Row order, ids and other columns have no
influence.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from loomstat.llm.common import slices

MARK = "▁"
# Cuts a task remembers at most, and the longest one worth remembering: some 200 MB.
KNOWN_CUTS = 700_000
KNOWN_LENGTH = 64


class Codec:
    """One vocabulary: cutting, agenda, byte fallback, decoding. In a cut a blank stands for the word mark."""

    def __init__(self, path: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.texts = {}, []
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i)):
                if library.is_unused(i):
                    raise ValueError("vocabularies with unused pieces are not supported")
                self.ids[piece] = i
            self.texts.append(piece)
        order = {score: n for n, score in enumerate(sorted({library.get_score(i) for i in self.ids.values()}, reverse=True))}
        self.ranks = {piece: order[library.get_score(i)] for piece, i in self.ids.items()}
        self.controls = {i for i in range(library.get_piece_size()) if library.is_control(i)}
        self.unknown, self.end = library.unk_id(), library.eos_id()
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(library.is_byte(i) for i in self.bytes)
        self.byte_of = {i: b for b, i in enumerate(self.bytes)} if self.fallback else {}
        # cut -> its ids as decimal text; cuts whose ids do not decode to the cut itself have their text here.
        self.known: dict[str, str] = {}
        self.changed: dict[str, str] = {}
        self.long: list[str] = []
        self.cutter = self._cutter()
        if library.normalize("a b\tＡ ﬁ") != f"{MARK}a{MARK}b\tＡ{MARK}ﬁ":
            raise ValueError("only vocabularies that change nothing but blanks are supported")

    def _cutter(self) -> re.Pattern:
        """Cuts a text, blanks as marks, only where no piece of the vocabulary reaches across."""
        longer = [p for p in self.ids if len(p) > 1]
        pairs = {p[i:i + 2] for p in longer for i in range(len(p) - 1)}
        if any(b == MARK != a for a, b in pairs):
            raise ValueError("a piece has a word mark inside, so words cannot be encoded one by one")
        self.pairs = pairs
        inside = {c for pair in pairs for c in pair}
        alone = "".join(c for c in "\t\n\r" if c not in inside)
        # A sign that no piece has behind a letter, digit or the like begins a new cut there; other signs do not.
        signs = set(string.punctuation)
        begins = signs - {b for a, b in pairs if b in signs and a not in signs and a != MARK}
        goes_on, alone, signs = (re.escape("".join(sorted(c))) for c in (signs - begins, alone, signs))
        tail = f"[^ {alone}]*"
        word = f" *[^ {alone}{signs}]+" + (f"(?:[{goes_on}]{tail})?" if goes_on else "")
        return re.compile(f"{word}| *[{signs}]{tail}| +" + (f"|[{alone}]" if alone else ""))

    def cuts(self, text: str) -> list[str]:
        return self.cutter.findall(" " + text.replace(MARK, " ")) if text else []

    def pieces(self, cut: str) -> list[str]:
        """The agenda over one cut."""
        symbols: list[str | None] = list(cut.replace(" ", MARK))
        n = len(symbols)
        before, after, ranks = list(range(-1, n - 1)), [*range(1, n), -1], self.ranks
        # An entry is rank * n + left: the best score first, of equal scores the leftmost.
        agenda = [
            rank * n + i for i in range(n - 1) if (rank := ranks.get(symbols[i] + symbols[i + 1])) is not None
        ]
        heapq.heapify(agenda)
        while agenda:
            rank, left = divmod(heapq.heappop(agenda), n)
            first, right = symbols[left], after[left]
            if first is None or right < 0:
                continue
            joined = first + symbols[right]
            if ranks.get(joined) != rank:
                continue  # the pair has changed since
            symbols[left], symbols[right] = joined, None
            right = after[left] = after[right]
            if right >= 0:
                before[right] = left
                if (rank := ranks.get(joined + symbols[right])) is not None:
                    heapq.heappush(agenda, rank * n + left)
            left = before[left]
            if left >= 0 and (rank := ranks.get(symbols[left] + joined)) is not None:
                heapq.heappush(agenda, rank * n + left)
        return [s for s in symbols if s is not None]

    def cut_ids(self, cut: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(cut):
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            elif self.fallback:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return out

    def _parts(self, cut: str) -> list[str]:
        """``cut`` taken apart between neighbours that stand side by side in no piece."""
        marked, pairs = cut.replace(" ", MARK), self.pairs
        ends = [i for i in range(1, len(cut)) if marked[i - 1:i + 1] not in pairs]
        return [cut[i:j] for i, j in zip([0, *ends], [*ends, len(cut)])] if ends else [cut]

    def _learn(self, cuts: list[str], check: bool) -> None:
        """Remember new cuts; what the agenda gives for their parts is held against the library in one call."""
        known = self.known
        apart = [self._parts(c) for c in cuts]
        parts = list({p for ps in apart for p in ps if p not in known})
        found = [self.cut_ids(p) for p in parts]
        if check:
            # The library puts a mark before a text, so a part without one is encoded behind a newline, which no
            # piece crosses; what it gives for mark and newline is taken off.
            texts = [p[1:] if p[0] == " " else "\n" + p for p in parts]
            lead = len(self.library.encode("\n"))
            for part, text, ours, theirs in zip(parts, texts, found, self.library.encode(texts, num_threads=1)):
                if text and (theirs if part[0] == " " else theirs[lead:]) != ours:
                    raise AssertionError(f"{part!r}: {ours} differs from the library's {theirs}")
        mark = self.ids[MARK]
        for part, ids in zip(parts, found):
            known[part] = " ".join(map(str, ids))
            # A text loses its first blank, so each is decoded behind one.
            if (text := self.decode([mark, *ids])) != part:
                self.changed[part] = text
        for cut, ps in zip(cuts, apart):
            if len(ps) > 1:
                known[cut] = " ".join([known[p] for p in ps])
                if self.changed and any(p in self.changed for p in ps):
                    self.changed[cut] = "".join(self.changed.get(p, p) for p in ps)
        self.long += [c for c in parts + cuts if len(c) > KNOWN_LENGTH]

    def encode(self, texts: list[str | None], check: bool = True) -> list[tuple[list[str], dict[str, str]]]:
        """Per text its cuts, with a table that has each cut's ids as text; it holds until the next call."""
        for cut in self.long:
            self.known.pop(cut, None)
        self.long = []
        if len(self.known) > KNOWN_CUTS:
            self.known = {}
        parts = [self.cuts(t or "") for t in texts]
        known = self.known
        fresh = list({c for cuts in parts for c in cuts if c not in known})
        if fresh:
            self._learn(fresh, check)
        return [(cuts, known) for cuts in parts]

    def decoded(self, cuts: list[str]) -> str:
        """What :meth:`decode` gives for the ids of ``cuts``."""
        if self.changed:
            cuts = [self.changed.get(c, c) for c in cuts]
        return "".join(cuts)[1:]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, byte pieces read as UTF-8, marks as blanks, the first mark left out."""
        out: list[str] = []
        raw = bytearray()
        leading = True
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                raw.append(byte)
                leading = False
                continue
            if raw:
                out.append(_utf8(raw))
                raw.clear()
            if i in self.controls:
                continue
            if i == self.unknown:
                out.append(" ⁇ ")
            else:
                piece = self.texts[i]
                if leading and piece[0] == MARK:
                    piece = piece[1:]
                out.append(piece.replace(MARK, " "))
            leading = False
        if raw:
            out.append(_utf8(raw))
        return "".join(out)


def _utf8(raw: bytearray) -> str:
    """Bytes as text, U+FFFD for each byte that belongs to no character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i:i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_ids(text: Column | str, path: str, *, end: bool = True) -> Column:
    """The ids of a text column as ``array<int>``."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        own = codec(path)
        tail = [own.end] if end else []
        out = []
        for piece in slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
            rows = own.encode(piece.column("text").to_pylist())
            out += [[int(i) for c in cuts for i in table[c].split()] + tail for cuts, table in rows]
        return pa.array(out, pa.list_(pa.int32()))

    return run(text)


def decode_ids(ids: Column | str, path: str) -> Column:
    """The text of an ``array<int>`` column of ids; null stays null."""

    @F.arrow_udf(StringType())
    def run(rows: pa.Array) -> pa.Array:
        own = codec(path)
        return pa.array([None if r is None else own.decode(r) for r in rows.to_pylist()], pa.string())

    return run(ids)


ENCODED = StructType([
    StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
])


def encoded(text: Column | str, path: str) -> Column:
    """The ids of a text column together with their digests, from one pass: ``ids, n_tokens, ids_sha256, decoded_sha256``.

    Ids are kept as 32-bit arrays, a few rows' worth at a time, however many rows an Arrow batch has.
    """

    @F.arrow_udf(ENCODED)
    def run(texts: pa.Array) -> pa.Array:
        own = codec(path)
        done = []
        for piece in slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
            ids, sizes, hashes, decoded = [], [], [], []
            for cuts, table in own.encode(piece.column("text").to_pylist()):
                joined = " ".join([*(table[c] for c in cuts), str(own.end)])
                ids.append(np.fromstring(joined, np.int32, sep=" "))
                sizes.append(len(ids[-1]))
                hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decoded(cuts).encode()).hexdigest())
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            done.append(pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(sizes, pa.int64()),
                 pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                ENCODED.names,
            ))
        return pa.concat_arrays(done) if done else pa.array([], pa.struct(
            [("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        ))

    return run(text)


DIGEST = StructType([
    StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
])


def digest(text: Column | str, path: str) -> Column:
    """Number of ids, SHA-256 of the ids as text and of the decoded text, without a column of ids."""

    @F.arrow_udf(DIGEST)
    def run(texts: pa.Array) -> pa.Array:
        own = codec(path)
        out: list[list] = [[], [], []]
        for piece in slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
            for cuts, table in own.encode(piece.column("text").to_pylist()):
                written = [table[c] for c in cuts]
                written.append(str(own.end))
                joined = " ".join(written)
                out[0].append(joined.count(" ") + 1)
                out[1].append(hashlib.sha256(joined.encode()).hexdigest())
                out[2].append(hashlib.sha256(own.decoded(cuts).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return run(text)
