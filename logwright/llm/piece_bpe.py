"""SentencePiece (merge type) encoding and decoding by backtracking.

Method. The vocabulary's pieces go into an Aho-Corasick automaton; one pass over
a string finds every piece in it, so the longest piece at each position and the
next shorter ones are known. Encoding then takes the longest piece whose
neighbour on the left accepts it: two pieces are compatible if merging their
joined characters again, best score first, gives exactly these two pieces. If
no piece at a position is compatible the last piece is taken back and its next
shorter one is tried; a bitfield marks positions that were found to lead
nowhere, so none is tried twice. A sequence whose neighbours are all compatible
is the one that greedy merging makes: the first merge across a border in the
whole string would also occur in the two pieces alone.

Exactness of cutting. No piece of the vocabulary holds the blank mark after
another character and none spans a character that is outside the vocabulary
(both are checked when a model is loaded), so no merge crosses a blank or such a
character. Texts are cut there and each different chunk is encoded once per
worker (bounded cache), cut further between characters that no piece holds side by
side. A vocabulary for which the first check fails is encoded
with whole texts as chunks.

Null texts count as empty; empty texts encode to the end id only.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import prepare

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks whose ids a worker keeps, and the longest chunk that is kept.
CACHE_CHUNKS, CACHE_PARTS, CACHE_CHARS = 700_000, 200_000, 48


class Model:
    """Vocabulary of a SentencePiece model file, read with the library's accessors."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        proc = sentencepiece.SentencePieceProcessor(model_file=path)
        n = proc.vocab_size()
        self.eos = proc.eos_id()
        self.pieces = [proc.id_to_piece(i) for i in range(n)]
        self.silent = {i for i in range(n) if proc.is_control(i)}
        self.unk = proc.unk_id()
        self.bytes = {}
        self.byte_of = {}
        self.ids, self.score = {}, {}
        for i, piece in enumerate(self.pieces):
            if proc.is_byte(i):
                b = int(piece[3:5], 16)
                self.bytes[b], self.byte_of[i] = i, b
            elif i not in self.silent and i != self.unk and not proc.is_unused(i):
                self.ids[piece] = i
                self.score[piece] = proc.get_score(i)
        self.known = {c for c in self.ids if len(c) == 1}
        self._plain = frozenset(self.ids.values())
        self.cut_at_blank = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        if not all(c in self.known for p in self.ids for c in p) or len(self.bytes) != 256:
            raise ValueError("model needs single characters for all pieces and byte fallback")
        self.auto = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.auto.add_word(p, i)
        self.auto.make_automaton()
        self._decimal = [f" {i}" for i in range(n)]
        # two characters that no piece holds side by side never merge: a place to cut
        self._pairs = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self._size = [len(p) for p in self.pieces]
        # by left neighbour: whether a piece is compatible; the last row is the start of a string
        self._fits: list[dict[int, bool]] = [{} for _ in range(n + 1)]
        self._words: dict[str, str] = {}  # words after a blank
        self._cache: dict[str, str] = {}  # parts of words and other chunks

    # --- merging, used on two pieces only ---------------------------------
    def merged(self, text: str) -> list[str]:
        """Greedy merging: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a (or start a string, if a is past the last id)."""
        left = [self.pieces[a]] if a < len(self.pieces) else []
        parts = [*left, self.pieces[b]]
        ok = self._fits[a][b] = self.merged("".join(parts)) == parts
        return ok

    # --- backtracking -------------------------------------------------------
    def span(self, text: str) -> list[int]:
        """Ids of a string of known characters."""
        n, size, rows = len(text), self._size, self._fits
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        for end, i in self.auto.iter(text):  # ends ascend: shortest first
            starts[end + 1 - size[i]].append(i)
        dead = bytearray(n + 1)  # bitfield of failed positions
        ids: list[int] = []
        undo: list[tuple[int, int]] = []
        last, pos = len(self.pieces), 0
        options = starts[0]
        k = len(options)  # next option: options[k - 1]
        while pos < n:
            row = rows[last]
            while k:
                k -= 1
                i = options[k]
                if dead[pos + size[i]]:
                    continue
                ok = row.get(i)
                if ok or (ok is None and self.fits(last, i)):
                    undo.append((pos, k))
                    ids.append(i)
                    last = i
                    pos += size[i]
                    options = starts[pos]
                    k = len(options)
                    break
            else:
                if not undo:
                    raise ValueError("no compatible sequence")
                dead[pos] = 1
                pos, k = undo.pop()
                options = starts[pos]
                ids.pop()
                last = ids[-1] if ids else len(self.pieces)
        return ids

    def chunk(self, text: str) -> list[int]:
        """Ids of a chunk, blanks already marked."""
        if self.known.issuperset(text):
            return self.span(text) if text else []
        known, ids, at = self.known, [], 0
        for k, c in enumerate(text):
            if c not in known:
                if k > at:
                    ids += self.span(text[at:k])
                ids += [self.bytes[b] for b in c.encode()]
                at = k + 1
        if at < len(text):
            ids += self.span(text[at:])
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without an end id."""
        return [i for c in self.chunks(text) for i in self.chunk(c)]

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.cut_at_blank:
            return [BLANK + text.replace(" ", BLANK)]
        if "  " in text or text[0] == " " or text[-1] == " " or BLANK in text:
            return re.findall(f"{BLANK}+[^{BLANK}]*", BLANK + text.replace(" ", BLANK))
        return [BLANK + w for w in text.split(" ")]

    def marked(self, ids) -> str:
        """Text of ids with blanks still marked; byte pieces join into characters."""
        if self._plain.issuperset(ids):
            return "".join([self.pieces[i] for i in ids])
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.silent:
                out.append(self.pieces[i] if i != self.unk else " ⁇ ")
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    @staticmethod
    def unmark(text: str) -> str:
        return (text[1:] if text.startswith(BLANK) else text).replace(BLANK, " ")

    def decode(self, ids) -> str:
        return self.unmark(self.marked(ids))

    def line(self, chunk: str) -> str:
        """Decimal ids of a chunk, a blank before each; checked to decode to the chunk.

        A chunk ends at a character border, so the decoded texts of chunks can be joined.
        Chunks are cut further between characters that no piece holds side by side.
        """
        pairs, cache = self._pairs, self._cache
        cuts = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in pairs]
        if not cuts:
            return self._line(chunk)
        out = []
        for a, z in zip([0, *cuts], [*cuts, len(chunk)]):
            part = chunk[a:z]
            got = cache.get(part)
            if got is None:
                got = self._line(part)
                if z - a <= CACHE_CHARS and len(cache) < CACHE_PARTS:
                    cache[part] = got
            out.append(got)
        return "".join(out)

    def word(self, word: str) -> str:
        """:meth:`line` of a word after a blank, kept under the bare word."""
        line = self.line(BLANK + word)
        if len(word) < CACHE_CHARS and len(self._words) < CACHE_CHUNKS:
            self._words[word] = line
        return line

    def _line(self, chunk: str) -> str:
        ids = self.chunk(chunk)
        if self.marked(ids) != chunk:
            raise ValueError(f"ids do not decode to {chunk!r}")
        line = "".join([self._decimal[i] for i in ids])
        return line

    def digest(self, text: str) -> tuple[int, str, str]:
        """n_tokens with the end id, SHA-256 of the decimal ids, SHA-256 of the decoded text.

        Every chunk's ids have been decoded and compared (``line``), so the decoded
        text is the joined chunks.
        """
        if self.cut_at_blank and text and not ("  " in text or text[0] == " " or text[-1] == " " or BLANK in text):
            get, word = self._words.get, self.word
            ids = "".join([get(w) or word(w) for w in text.split(" ")]) + f" {self.eos}"
            back = text
        else:
            get, line = self._cache.get, self.line
            parts = self.chunks(text)
            ids = "".join([get(c) or line(c) for c in parts]) + f" {self.eos}"
            back = self.unmark("".join(parts))
        return (ids.count(" "), hashlib.sha256(ids[1:].encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest())


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def encode_texts(df: DataFrame, model_path: str, text_col: str = "text",
                 out_col: str = "piece_ids", end_id: bool = True) -> DataFrame:
    """``df`` with the ids of each text (array<int>); a null text has the end id only."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    prepare(df.sparkSession)
    df = df.drop(out_col)  # an input column of this name is replaced

    def run(batches):
        m = load(model_path)
        for b in batches:
            ids = [m.encode(t or "") + [m.eos] * end_id
                   for t in b.column(text_col).to_pylist()]
            yield b.append_column(out_col, pa.array(ids, pa.list_(pa.int32())))
    schema = StructType([*df.schema.fields, StructField(out_col, ArrayType(IntegerType()))])
    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, model_path: str, ids_col: str = "piece_ids",
               out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each id list; null ids decode to the empty text."""
    from pyspark.sql.types import StringType, StructField, StructType

    prepare(df.sparkSession)
    df = df.drop(out_col)  # an input column of this name is replaced

    def run(batches):
        m = load(model_path)
        for b in batches:
            text = [m.decode(i or []) for i in b.column(ids_col).to_pylist()]
            yield b.append_column(out_col, pa.array(text, pa.string()))
    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out_col, StringType())]))


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode every text; one row per document row.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256. Repeated rows each give
    a row, a null doc_id stays null, further columns are ignored. Texts are
    handled one at a time, so memory follows the longest text, not the batch.
    """
    prepare(docs.sparkSession)

    def run(batches):
        m = load(model_path)
        for b in batches:
            rows = [m.digest(t.as_py() or "") for t in b.column(1)]
            n, a, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                 pa.array(d, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
