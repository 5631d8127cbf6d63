"""Token ids and counts of a byte-level BPE vocabulary, also for documents far too long for one call.

Where a text may be cut: the splitting pattern of these vocabularies never lets a piece run from a character that
is not white space into white space, whatever surrounds it, and merges never cross pieces.  So a run of white space
after another character always starts a token, and what follows does not depend on what came before: a proven stable boundary.
``Encoder`` uses it to remember the ids of whole pieces (white space and the word after it).

With the byte-level pattern of GPT-2, a run of letters also ends before any other character, and what follows does not depend on it either.  So
a piece ends before ASCII punctuation after a letter too (not before characters of added tokens), and a space and letters are one unit of merging, for
which the model is asked directly, without the splitting.

Overlap resynchronisation: documents of more than ``chunk`` characters are cut into chunks that overlap.  Each is encoded
on its own, with the offsets of its stable boundaries.  Neighbours are spliced at the first boundary in the overlap that both have; where
there is none, the overlap of that document is doubled and it is encoded again, until one chunk is the whole document.

Nulls: a null text counts as an empty one, which has no token.  An empty table gives no row.  Repeated rows are counted one by one.
Other columns are not read.
"""

from __future__ import annotations

import codecs
import re
import string
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import stored, text_of

#: White space as the vocabularies' splitting pattern knows it (Unicode property White_Space); fixed values.
SPACE = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: The same in UTF-8: single bytes, and longer ones by their first byte and as numbers.
_SINGLE = np.isin(np.arange(256), [ord(c) for c in SPACE if ord(c) < 128])
_LONGER = np.array([int.from_bytes(c.encode(), "big") << 8 * (3 - len(c.encode())) for c in SPACE if ord(c) >= 128])
_LEADS = np.isin(np.arange(256), _LONGER >> 16)

#: Pieces of one generation that an encoder remembers; the generation before is kept too, so frequent pieces stay known.
REMEMBER = 900_000
#: Pieces of so many bytes are looked up all at once, by their bytes as two numbers.
SHORT = 16
#: Pieces that the library is asked for in one row.
TOGETHER = 1000
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters are told from other characters below this code point: one or two bytes in UTF-8.
LETTERS = 0x800


def _alphabet() -> str:
    """The characters that stand for the 256 bytes in byte-level vocabularies."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in same else next(others)) for b in range(256))


_ALPHABET = _alphabet()


def _plain(tokenizer) -> bool:
    """Whether it is byte-level with the pattern of GPT-2 and nothing else that looks across a cut."""
    from tokenizers import models, pre_tokenizers

    first, model = tokenizer.pre_tokenizer, tokenizer.model
    return (
        tokenizer.normalizer is None
        and isinstance(first, pre_tokenizers.ByteLevel) and first.use_regex and not first.add_prefix_space
        and isinstance(model, models.BPE) and not (model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix)
        and not any(t.single_word or t.lstrip or t.rstrip for t in tokenizer.get_added_tokens_decoder().values())
    )


def _piece_starts(data: np.ndarray, ends: np.ndarray, letters: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts laid end to end: with each text, with white space after another character, and with a byte of ``breaks`` after a letter."""
    n = int(ends[-1]) if len(ends) else 0
    space = _SINGLE[data]
    if n and data.max() >= 0xC2:
        lead = np.flatnonzero(_LEADS[data])
        two = data[lead] == 0xC2
        code = data[lead].astype(np.int64) << 16 | data[lead + 1].astype(np.int64) << 8 | np.where(two, 0, data[lead + 2])
        some = np.isin(code, _LONGER)
        lead, two = lead[some], two[some]
        space[lead] = space[lead + 1] = True
        space[lead[~two] + 2] = True
    begin = np.zeros(n, bool)
    begin[1:] = space[1:n] & ~space[: n - 1] if n else False
    broken = np.flatnonzero(breaks[data[:n]])
    broken = broken[broken > 1]  # at 1 a letter of two bytes has no room
    one, two = data[broken - 2].astype(np.int64), data[broken - 1].astype(np.int64)
    code = np.where(two < 0x80, two, np.where((one >= 0xC2) & (one < 0xE0), (one & 0x1F) << 6 | two & 0x3F, 0))
    begin[broken[letters[code]]] = True
    begins = np.append(0, ends[:-1])
    begin[begins[begins < n]] = True
    return np.flatnonzero(begin)


class Known:
    """Ids of pieces.  A short piece is found by its very bytes, as two numbers and its length, in an open table; a long one by a dictionary."""

    def __init__(self, places: int = 1 << 16):
        self.pieces, self.used, self.ids = 0, 0, np.zeros(1 << 16, np.uint32)
        self.long: dict[bytes, tuple[int, int]] = {}
        self._empty(places)

    def _empty(self, places: int) -> None:
        # Rows of the bytes as two numbers, and where the ids are << 16 | how many << 8 | the length: one place in memory for a look.
        self.rows = np.zeros((places, 3), np.uint64)

    def _place(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        x = (first ^ (second * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(65 - len(self.rows).bit_length())).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each short piece are and how many; -1 and 0 for one that is not known."""
        place, length = self._place(first, second), length.astype(np.uint64)
        held = self.rows.take(place, axis=0)
        out = held[:, 2]
        size = out & np.uint64(255)
        miss = np.flatnonzero((size != length) | (held[:, 0] != first) | (held[:, 1] != second))
        going = size[miss] != 0
        out[miss] = 0
        miss, place = miss[going], place[miss[going]]
        while len(miss):
            place = (place + 1) % len(self.rows)
            held = self.rows.take(place, axis=0)
            size = held[:, 2] & np.uint64(255)
            same = (size == length[miss]) & (held[:, 0] == first[miss]) & (held[:, 1] == second[miss])
            out[miss[same]] = held[same, 2]
            going = ~same & (size != 0)
            miss, place = miss[going], place[going]
        out = out.astype(np.int64)
        return np.where(out == 0, -1, out >> 16), out >> 8 & 255

    def _keep(self, ids: np.ndarray) -> int:
        at = self.used
        while at + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def add(self, first: np.ndarray, second: np.ndarray, length: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """Short pieces that are different and not known yet, with the number of their ids and those ids, one after the other."""
        at = self._keep(ids) + np.cumsum(n) - n
        rows = np.column_stack([first, second, (at << 16 | n << 8 | length).astype(np.uint64)])
        self.pieces += len(n)
        if 2 * self.pieces > len(self.rows):
            rows = np.concatenate([self.rows[self.rows[:, 2] != 0], rows])
            self._empty(1 << (2 * self.pieces).bit_length())
        place, todo = self._place(rows[:, 0], rows[:, 1]), np.arange(len(rows))
        while len(todo):
            free = todo[self.rows[place[todo], 2] == 0]
            _, one = np.unique(place[free], return_index=True)
            some = free[one]
            self.rows[place[some]] = rows[some]
            left = np.ones(len(rows), bool)
            left[some] = False
            todo = todo[left[todo]]
            place[todo] = (place[todo] + 1) % len(self.rows)

    def add_long(self, piece: bytes, ids: np.ndarray) -> None:
        self.long[piece] = (self._keep(ids), len(ids))

    @property
    def full(self) -> bool:
        return self.pieces + len(self.long) > REMEMBER or self.used > 8 * REMEMBER


class Encoder:
    """Ids as the library gives them for the vocabulary file, by pieces, which are remembered."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known, self.before = Known(), Known(2)
        # Bytes of each token: a character of the byte-level alphabet stands for one.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        added = {k: len(t.content.encode()) for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.sizes = np.zeros(max([*vocabulary.values(), *added], default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.sizes[list(added)] = list(added.values())
        # Which characters are letters is what the splitting says: between two letters only a letter splits nothing off.
        self.letters, self.breaks, self.word, self.model = np.zeros(LETTERS, bool), np.zeros(256, bool), None, self.tokenizer.model
        if _plain(self.tokenizer):
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.letters[:] = [len(split(f"a{chr(c)}a")) == 1 for c in range(LETTERS)]
            contents = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
            self.breaks[[ord(c) for c in string.punctuation if c not in contents]] = True
            known = "".join(re.escape(chr(c)) for c in np.flatnonzero(self.letters).tolist())
            # No added token may hide in a word: each has a character that words have not.
            if all(re.search(f"[^ {known}]", t.content) for t in self.tokenizer.get_added_tokens_decoder().values()):
                self.word = re.compile(f" ?[{known}]+").fullmatch

    def _each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and the number of each."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found))), np.array([len(x) for x in found], np.int64)

    def _ask(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same; what is a space and letters is asked of the model."""
        word, model, encode = self.word, self.model.tokenize, codecs.charmap_decode
        plain = np.array([word is not None and word(p.decode()) is not None for p in pieces], bool)
        ids, n, tell, number = [], [], plain.tolist(), attrgetter("id")
        for p, is_word in zip(pieces, tell):
            if is_word:
                found = model(encode(p, "strict", _ALPHABET)[0])
                ids.extend(map(number, found))
                n.append(len(found))
        others, n_others = self._ask_rows([p for p, is_word in zip(pieces, tell) if not is_word])
        n_of = np.zeros(len(pieces), np.int64)
        n_of[plain], n_of[~plain] = n, n_others
        both, of_words = np.zeros(int(n_of.sum()), np.uint32), np.repeat(plain, n_of)
        both[of_words], both[~of_words] = ids, others
        return both, n_of

    def _ask_rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same.  What begins with white space and ends with another character is no different where it stands in a row of such pieces;
        there the bytes of the tokens tell the pieces apart."""
        ids, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), TOGETHER):
            some = pieces[at : at + TOGETHER]
            row = [k for k, p in enumerate(some) if p[0] == 32 and 32 < p[-1] < 127]
            rest = [k for k, p in enumerate(some) if not (p[0] == 32 and 32 < p[-1] < 127)]
            ids_of, n_of = self._each([b"".join(some[k] for k in row)])
            ends = np.cumsum(self.sizes[ids_of])
            upto = np.cumsum([len(some[k]) for k in row])
            last = np.searchsorted(ends, upto)
            if not len(row) or not len(ends) or last[-1] != len(ends) - 1 or (ends[last] != upto).any():
                row, rest = [], list(range(len(some)))
                ids_of, last = ids_of[:0], last[:0]
            others, n_others = self._each([some[k] for k in rest])
            n_of = np.zeros(len(some), np.int64)
            n_of[row], n_of[rest] = np.diff(last, prepend=-1), n_others
            both = np.zeros(int(n_of.sum()), np.uint32)
            in_row = np.zeros(len(some), bool)
            in_row[row] = True
            in_row = np.repeat(in_row, n_of)
            both[in_row], both[~in_row] = ids_of, others
            ids.append(both)
            n.append(n_of)
        return np.concatenate(ids), np.concatenate(n)

    def _learn(self, raw: bytes, start: np.ndarray, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> None:
        """Short pieces that are not known: those of the generation before, and new ones."""
        order = np.lexsort((length, second, first))
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[order[1:]] != x[order[:-1]] for x in (first, second, length)], axis=0)
        start, first, second, length = (x[order[new]] for x in (start, first, second, length))
        at, n = self.before.find(first, second, length)
        was = at >= 0
        asked, n_asked = self._ask([raw[a:b] for a, b in zip(start[~was].tolist(), (start + length)[~was].tolist())])
        n[~was] = n_asked
        ids = np.zeros(int(n.sum()), np.uint32)
        from_before = np.repeat(was, n)
        ids[from_before] = self.before.ids[_ranges(at[was], n[was])]
        ids[~from_before] = asked
        self.known.add(first, second, length, n, ids)

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the texts, where each text ends, where its pieces start, and where the ids of each piece are and how many; all known afterwards."""
        if self.known.full:
            self.known, self.before = Known(len(self.known.rows)), self.known
        known, each = self.known, [t.encode() for t in texts]
        raw = b"".join([*each, bytes(SHORT)])
        ends = np.cumsum([len(x) for x in each], dtype=np.int64)
        data = np.frombuffer(raw, np.uint8)
        start = _piece_starts(data, ends, self.letters, self.breaks)
        length = np.diff(start, append=len(raw) - SHORT)
        words = np.ndarray((len(raw) - 7,), "<u8", data, strides=(1,))
        first = words[start] & _MASKS[np.minimum(length, 8)]
        second = words[start + 8] & _MASKS[np.clip(length - 8, 0, 8)]
        at, n = known.find(first, second, length)
        miss = np.flatnonzero((at < 0) & (length <= SHORT))
        if len(miss):
            fields = first[miss], second[miss], length[miss]
            self._learn(raw, start[miss], *fields)
            at[miss], n[miss] = known.find(*fields)
        long = np.flatnonzero(length > SHORT)
        if len(long):
            pieces = [raw[a:b] for a, b in zip(start[long].tolist(), (start + length)[long].tolist())]
            new = [p for p in dict.fromkeys(pieces) if p not in known.long]
            ids, counts = self._ask(new)
            for piece, some in zip(new, np.split(ids, np.cumsum(counts)[:-1])):
                known.add_long(piece, some)
            at[long], n[long] = np.array([known.long[p] for p in pieces], np.int64).T
        return data, ends, start, at, n

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        _, ends, start, at, n = self._pieces(texts)  # may start a new generation
        ids = self.known.ids[_ranges(at, n)]
        upto = np.append(0, np.cumsum(n))[np.searchsorted(start, ends)].tolist()
        return [ids[a:b] for a, b in zip([0, *upto[:-1]], upto)]

    def count(self, texts: list[str]) -> list[int]:
        _, ends, start, _, n = self._pieces(texts)
        return np.diff(np.append(0, np.cumsum(n))[np.searchsorted(start, ends)], prepend=0).tolist()

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece starts (in characters), and the tokens before it (with the total at the end)."""
        data, _, start, _, n = self._pieces([text])
        chars = np.cumsum((data & 0xC0) != 0x80)
        return chars[start] - 1, np.append(0, np.cumsum(n))


def _ranges(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(at - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _encoder(path: str) -> Encoder:
    """One per Python worker: workers outlive tasks, and what they remember stays useful."""
    import builtins

    made = getattr(builtins, "_llm_encoders", None)
    if made is None:
        made = builtins._llm_encoders = {}
    if path not in made:
        made[path] = Encoder(path)
    return made[path]


def id_type(path: str) -> str:
    """The smallest type for the ids of a vocabulary: two bytes or four, unsigned, little-endian."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab().values(), default=0) < 1 << 16 else "<u4"


def batches(texts: list[str], most: int = 500_000) -> Iterator[list[str]]:
    """Texts in order, in lists of about so many characters."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def _short_counts(path: str):
    def count(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(path)
        for column in columns:
            out: list[int] = []
            for some in batches(column.tolist()):
                out += encoder.count(some)
            yield pd.Series(out, dtype="int64")

    return F.pandas_udf(count, "long")


#: A chunk as it is encoded: its number, where it begins, and whether it ends its document.
PART = "id long, k int, begin long, overlap int, last boolean, text string"


def _cut(chunk: int, overlap: int):
    """Chunks of each text, in time linear in its length: no chunk drags the whole text along."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for id_, text in zip(part["id"].tolist(), part["text"]):
                n = max(-(-(len(text) - overlap) // chunk), 1)
                for first in range(0, n, 64):
                    k = np.arange(first, min(first + 64, n))
                    texts = [text[b : b + chunk + overlap] for b in (k * chunk).tolist()]
                    yield pd.DataFrame(
                        {"id": id_, "k": k.astype(np.int32), "begin": k * chunk, "overlap": np.int32(overlap), "last": k == n - 1, "text": texts}
                    )

    return cut


#: Per chunk: its tokens, and the stable boundaries inside the overlaps with the chunks before and after it.
CHUNK = "id long, k int, tokens long, head_at array<long>, head array<long>, tail_at array<long>, tail array<long>"


def _encode_chunks(path: str):
    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        for part in parts:
            rows = []
            for id_, k, begin, overlap, last, text in part.itertuples(index=False):
                starts, before = encoder.offsets(text)
                # A boundary needs the character before it: the chunk's own start is none.
                own = np.flatnonzero(starts > 0)
                head = own[starts[own] < overlap] if k else own[:0]
                tail = own[starts[own] >= len(text) - overlap] if not last else own[:0]
                rows.append(
                    (id_, k, int(before[-1]), (begin + starts[head]).tolist(), before[head].tolist(),
                     (begin + starts[tail]).tolist(), before[tail].tolist())
                )
            yield pd.DataFrame(rows, columns=["id", "k", "tokens", "head_at", "head", "tail_at", "tail"])

    return encode


def splice(chunks: pd.DataFrame) -> pd.DataFrame:
    """Tokens of one document from its chunks; null where two neighbours share no boundary."""
    chunks = chunks.sort_values("k")
    total, skip = 0, 0
    rows = list(chunks.itertuples(index=False))
    for this, following in zip(rows, rows[1:]):
        heads = dict(zip(following.head_at, following.head))
        common = next(((t, heads[at]) for at, t in zip(this.tail_at, this.tail) if at in heads and t >= skip), None)
        if common is None:
            return pd.DataFrame({"id": [rows[0].id], "n_tokens": [None]}, dtype="Int64")
        total += common[0] - skip
        skip = common[1]
    total += rows[-1].tokens - skip
    return pd.DataFrame({"id": [rows[0].id], "n_tokens": [total]}, dtype="Int64")


def long_counts(long: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``id, n_tokens`` for the rows ``id, text``."""
    out = None
    todo = long
    while True:
        cut = todo.select("id", "text").mapInPandas(_cut(chunk, overlap), PART)
        # Chunks of one document are dealt over all tasks.
        encoded = cut.repartition("id", "k").mapInPandas(_encode_chunks(path), CHUNK)
        spliced = stored(encoded.groupBy("id").applyInPandas(splice, "id long, n_tokens long"), "spliced")
        done = spliced.where("n_tokens IS NOT NULL")
        out = done if out is None else out.union(done)
        failed = spliced.where("n_tokens IS NULL").select("id")
        if failed.isEmpty():
            return out
        todo = todo.join(stored(failed, "again"), "id", "left_semi")
        overlap, chunk = 2 * overlap, max(chunk, 2 * overlap)


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = 1024, chunk: int = 32_768, overlap: int = 512
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    path = path or vocabulary()
    text = text_of()
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    is_long = F.char_length("text") > chunk + overlap
    # A row's own number ties the chunks together, so repeated doc_ids do not mix.
    long = stored(rows.where(is_long).withColumn("id", F.monotonically_increasing_id()), "long")
    counted = long_counts(long.select("id", "text"), path, chunk, overlap)
    counts = long.select("id", "doc_id", "n_bytes").join(counted, "id").drop("id")
    short = rows.where(~is_long).select("doc_id", "n_bytes", _short_counts(path)("text").alias("n_tokens"))
    return short.unionByName(counts).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
