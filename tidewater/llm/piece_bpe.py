"""Sentence-piece encoding and decoding of merge-type vocabularies.

The library merges, again and again, the adjacent pair whose joined piece has
the best score.  The same result is reached here without a merge queue
(exact encoding by backtracking):

* Aho-Corasick matching finds the longest piece starting at each position;
* a piece may follow another only if re-merging the two pieces' characters
  gives these two pieces again (kept in a table of pairs);
* if no piece fits, the position is marked in a bitfield of failed positions
  and the piece before it is replaced by the next shorter one.

A text has one sequence whose neighbours are all compatible, the merge
result, so the search never tries a failed position twice and is linear in
the text in practice.  Re-merging two pieces only needs their edges: each
piece's last and first parts change at known scores, and the pieces stay apart
unless two edges that are there at the same time join at a better score than
that at which either of them goes (``Coder.compatible``).

No piece has a space mark after another character, so words are encoded apart:
the texts of a batch are cut into words, equal words are found, and each is
encoded once, or taken from the words that the worker remembers (the memory is
bounded in bytes); gathering them by the words' numbers gives the texts' ids.
Runs of space marks have pieces of equal, lowest score; they are merged last, so they are
merged alone, by run length.

Null texts count as empty; empty texts give the begin and end ids only.
Characters without a piece become the ids of their UTF-8 bytes.
"""

from __future__ import annotations

import heapq
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Sent, map_texts, ship

ship(__name__)

SPACE = "▁"
#: Rank of what does not happen.
NEVER = float("inf")
#: Bytes of words and ids, and pairs of pieces, that a worker remembers.
MEMORY, PAIRS = 16_000_000, 100_000
#: Rows, and characters of texts, that are cut into words at a time.
ROWS, CHARACTERS = 1024, 4_000_000
#: Texts the vocabulary's rules are tried on when it is read.
PROBES = ("", " ", "a", "  a  b ", "a\tb\nc", "é▁x", " \n ", "　ﬁ ሴ", "the   words▁▁ of it!! \U0001f600")


def merged(symbols: list[str], rank: dict[str, float], joins: list | None = None) -> list[str]:
    """The library's rule: join the adjacent pair of best rank (lowest number),
    the leftmost of equals, until none is left.  ``joins`` gets every join as
    (rank, first symbol, symbol after the last)."""
    n = len(symbols)
    part, nxt, prv = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank[j], i, len(part[i]), len(part[i + 1])) for i in range(n - 1) if (j := part[i] + part[i + 1]) in rank]
    heapq.heapify(heap)

    def offer(i: int, k: int) -> None:
        if i >= 0 and k < n and (j := part[i] + part[k]) in rank:
            heapq.heappush(heap, (rank[j], i, len(part[i]), len(part[k])))

    while heap:
        _, i, a, b = heapq.heappop(heap)
        k = nxt[i]
        if len(part[i]) != a or k >= n or len(part[k]) != b:
            continue
        part[i] += part[k]
        part[k] = ""
        nxt[i] = nxt[k]
        if joins is not None:
            joins.append((rank[part[i]], i, nxt[i]))
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(prv[i], i)
        offer(i, nxt[i])
    return [p for p in part if p]


class Vocabulary:
    """Pieces, ids and merge ranks; small (a vocabulary file), sent to tasks."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(lib.get_piece_size())
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.control = [i for i in every if lib.is_control(i)]
        self.byte_ids = [i for i in every if lib.is_byte(i)]
        special = {self.unknown, *self.control, *self.byte_ids}
        self.pieces = [lib.id_to_piece(i) for i in every]
        self.ids = {self.pieces[i]: i for i in every if i not in special}
        scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        runs = {p for p in self.ids if len(p) > 1 and not p.strip(SPACE)}
        joined = {p: s for p, s in scores.items() if len(p) > 1 and p not in runs}
        if len(self.byte_ids) != 256 or min(self.begin, self.end) < 0:
            raise ValueError("the vocabulary needs byte pieces and begin and end ids")
        if any(SPACE in p[1:] for p in joined) or len(set(joined.values())) < len(joined):
            raise ValueError("pieces that span words, or share a score, are not supported")
        if runs and joined and max(scores[p] for p in runs) >= min(joined.values()):
            raise ValueError("runs of space marks must have the lowest scores")
        self.rank = {p: -s for p, s in joined.items()}
        self.known_edges: dict[str, tuple | None] = {}
        self.parts: dict[str, str] = {}  # so that equal parts are one string
        self.run_rank = {p: -scores[p] for p in runs}
        # Pieces that merging reaches; others are never the result.
        self.whole = [p for p in self.ids if p not in runs and (len(p) == 1 or merged(list(p), self.rank) == [p])]
        self.sole = {p: self.ids[p] for p in self.whole}
        self._coder = None
        coder = Coder(self)  # not kept: the broadcast stays small
        for text in PROBES:
            ids = np.frombuffer(coder.encode(text), "<u4").tolist()
            if ids != lib.encode(text, add_bos=True, add_eos=True) or coder.decode(ids) != lib.decode(ids):
                raise ValueError(f"this vocabulary's text rules are not supported: {text!r}")

    def edges(self, piece: str) -> tuple[tuple, tuple] | None:
        """The parts that begin and those that end with the piece's outer
        characters while it is merged, each with the rank at which it goes
        (``NEVER`` for the piece).  None if the joins' ranks don't ascend."""
        if piece not in self.known_edges:
            joins: list = []
            merged(list(piece), self.rank, joins)
            n, order = len(piece), [r for r, _, _ in joins]
            starts, ends = [piece[0]], [piece[-1]]
            for r, i, k in joins:  # (part, rank at which it goes), flat
                if i == 0:
                    starts += [r, self.parts.setdefault(piece[:k], piece[:k])]
                if k == n:
                    ends += [r, self.parts.setdefault(piece[i:], piece[i:])]
            self.known_edges[piece] = ((*starts, NEVER), (*ends, NEVER)) if order == sorted(order) else None
        return self.known_edges[piece]

    def coder(self) -> Coder:
        """One coder for each Python worker, kept with the broadcast value, so
        what a task has learned serves the worker's next tasks."""
        if self._coder is None:
            self._coder = Coder(self)
        return self._coder


class Words:
    """Packed ids of words with their space marks (none for an empty word), by
    Arrow arrays of the words met.  When these are over ``MEMORY``, only the
    words of the last batch are kept.  ``cold`` encodes a list of words not met
    before."""

    def __init__(self, cold):
        self.cold, self.known, self.ids = cold, None, None

    def __call__(self, words):
        """An array of words to one of packed ids."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.known is None:
            self.known, self.ids = pa.array([""], pa.string()), pa.array([b""], pa.binary())
        found = pc.index_in(words, self.known)
        if found.null_count:
            new = words.filter(found.is_null()).dictionary_encode()
            at = found.to_numpy(zero_copy_only=False)
            at[np.isnan(at)] = new.indices.to_numpy() + len(self.known)
            found = at.astype(np.int32)
            self.ids = pa.concat_arrays([self.ids, pa.array(self.cold(new.dictionary.to_pylist()), pa.binary())])
            self.known = pa.concat_arrays([self.known, new.dictionary])
        out = self.ids.take(pa.array(found))
        if self.known.nbytes + self.ids.nbytes > MEMORY:
            last = pa.array(np.unique(np.append(found, 0)))
            self.known, self.ids = self.known.take(last), self.ids.take(last)
        return out


class Packer:
    """Packed ids of whole texts from those of their words; ``kind`` is the
    ids' type (of module ``array``)."""

    def __init__(self, vocabulary: Vocabulary, kind: str, cold):
        self.v, self.kind, self.words, self.runs = vocabulary, kind, Words(cold), {}
        self.mark, self.head, self.tail = (array(kind, [i]).tobytes() for i in (vocabulary.ids[SPACE], vocabulary.begin, vocabulary.end))

    def run_ids(self, n: int) -> bytes:
        """Packed ids of ``n`` space marks that no word takes."""
        if n not in self.runs:
            if len(self.runs) >= 10_000:
                self.runs.clear()
            self.runs[n] = array(self.kind, [self.v.ids[p] for p in merged([SPACE] * n, self.v.run_rank)]).tobytes()
        return self.runs[n]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids with begin and end of every text."""
        out, group, size = [self.head + self.tail] * len(texts), [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if group and size + len(t) > CHARACTERS:
                self._encode_group(texts, group, out)
                group, size = [], 0
            group.append(i)
            size += len(t)
        if group:
            self._encode_group(texts, group, out)
        return out

    def _encode_group(self, texts: list, group: list[int], out: list) -> None:
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = pc.split_pattern(pa.array([texts[i].replace(SPACE, " ") for i in group], pa.string()), " ")
        _, ends, data = self.words(parts.values).buffers()
        ends, data = np.frombuffer(ends, np.int32), memoryview(data or b"")
        starts = parts.offsets.to_numpy()
        empty = np.append(0, np.cumsum(ends[1:] == ends[:-1]))
        for i, first, last in zip(group, starts.tolist(), starts[1:].tolist(), strict=False):
            if empty[first] == empty[last]:
                out[i] = b"".join((self.head, data[ends[first] : ends[last]], self.tail))
            else:
                out[i] = b"".join((self.head, *self._with_runs(ends[first : last + 1].tolist(), data), self.tail))

    def _with_runs(self, ends: list[int], data: memoryview):
        """Ids of words and, for the empty words between them, of space marks."""
        run, width = 0, len(self.mark)
        for start, end in zip(ends, ends[1:], strict=False):
            if start == end:
                run += 1
                continue
            if run:
                if data[start : start + width] == self.mark:
                    run, start = run + 1, start + width
                yield self.run_ids(run)
                run = 0
            yield data[start:end]
        if run:
            yield self.run_ids(run)


class Coder:
    """Encoder and decoder of one Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        v = self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for p in v.whole:
            if len(p) > 1:
                self.automaton.add_word(p, (len(p), v.ids[p]))
        self.automaton.make_automaton()
        known = set(v.whole)
        self.chars = {p: v.ids[p] for p in known if len(p) == 1}
        self.size = [len(p) for p in v.pieces]
        #: For each piece the longest shorter one that it begins with, or -1.
        self.shorter = [-1] * len(v.pieces)
        for p in v.whole:
            self.shorter[v.ids[p]] = next((v.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in known), -1)
        self.pairs: dict[int, bool] = {}
        self.packer = Packer(v, "I", lambda words: [array("I", self.word_ids(SPACE + w)).tobytes() for w in words])
        self.plain = [p.replace(SPACE, " ") for p in v.pieces]
        for i in v.control:
            self.plain[i] = ""
        self.plain[v.unknown] = " ⁇ "
        self.high = {}
        for b, i in enumerate(v.byte_ids):
            self.plain[i] = chr(b)
            if b >= 128:
                self.high[i] = b
        self.is_high = np.zeros(len(v.pieces), bool)
        self.is_high[list(self.high)] = True
        self.is_control = np.zeros(len(v.pieces), bool)
        self.is_control[v.control] = True
        self.texts = None

    def compatible(self, a: int, b: int) -> bool:
        """Whether re-merging the two pieces' characters gives them again."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        p, q = self.v.pieces[a], self.v.pieces[b]
        left, right = self.v.edges(p), self.v.edges(q)
        if left is None or right is None:
            ok = merged(list(p + q), self.v.rank) == [p, q]
        else:
            ok = self._apart(left[1], right[0])
        self.pairs[a << 32 | b] = ok
        return ok

    def _apart(self, ends: tuple, starts: tuple) -> bool:
        """Whether no end of the left piece joins a start of the right one
        while both are there; each comes with the rank at which it goes."""
        rank, i, k = self.v.rank, 0, 0
        while True:
            until_end, until_start = ends[i + 1], starts[k + 1]
            joint = rank.get(ends[i] + starts[k])
            # of equal ranks the leftmost join comes first
            if joint is not None and joint < until_end and joint <= until_start:
                return False
            if until_end <= until_start:
                if until_end == NEVER:
                    return True
                i += 2
            else:
                k += 2

    def backtrack(self, text: str, first: list[int]) -> list[int]:
        """Ids of a text all of whose characters have a piece (``first``)."""
        best = first.copy()
        for last, (size, piece) in self.automaton.iter(text):
            best[last - size + 1] = piece  # ends ascend, so the longest stays
        n, sizes, pairs = len(text), self.size, self.pairs
        failed = bytearray(n // 8 + 1)
        out: list[int] = []
        at, piece, before = 0, best[0], -1
        while True:
            to = at + sizes[piece]
            if not failed[to >> 3] >> (to & 7) & 1:
                ok = before < 0 or pairs.get(before << 32 | piece)
                if ok is None:
                    ok = self.compatible(before, piece)
                if ok:
                    out.append(piece)
                    if to == n:
                        return out
                    at, before, piece = to, piece, best[to]
                    continue
            piece = self.shorter[piece]
            if piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                before = out[-1] if out else -1
                at -= sizes[piece]

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word with its space mark."""
        whole = self.v.sole.get(word)
        if whole is not None:
            return [whole]
        first = list(map(self.chars.get, word))
        if None not in first:
            return self.backtrack(word, first)
        ids: list[int] = []
        start = 0
        for i, known in enumerate([*first, None]):
            if known is None:
                if start < i:
                    ids += self.backtrack(word[start:i], first[start:i])
                if i < len(word):
                    ids += [self.v.byte_ids[b] for b in word[i].encode("utf-8", "replace")]
                start = i + 1
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        return self.packer.encode_all([text])[0]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of any ids: control ids vanish, one leading space of the
        first piece goes, bytes that are no UTF-8 become U+FFFD each."""
        import pyarrow as pa

        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        if not self.is_high[ids].any():
            if self.texts is None:
                self.texts = pa.array(self.plain, pa.string())
            text = str(self.texts.take(pa.array(ids)).buffers()[2] or b"", "utf-8")
        else:
            out, run = [], bytearray()
            for i in ids.tolist():
                if i in self.high:
                    run.append(self.high[i])
                    continue
                if run:
                    out.append(_utf8(run))
                    run = bytearray()
                out.append(self.plain[i])
            text = "".join([*out, _utf8(run)])
        first = int(np.argmin(self.is_control[ids]))  # of the ids that are text
        begins = not self.is_control[ids[first]] and self.v.pieces[ids[first]].startswith(SPACE)
        return text[1:] if begins else text


def _utf8(raw: bytearray) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for size in (2, 3, 4):
            try:
                out.append(raw[i : i + size].decode("utf-8"))
                i += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` for every row: ids with begin and end as
    packed little-endian unsigned 32-bit integers; with ``decoded`` also the
    text that these ids decode to.  ``model`` is the vocabulary file's path
    on the driver; its content is sent to the tasks."""
    sent = Sent(docs.sparkSession, Vocabulary(model))

    def make():
        coder = sent.value.coder()

        def work(rows):
            ids = coder.packer.encode_all(rows["text"])
            out = {"doc_id": rows["doc_id"], "n_tokens": [len(b) // 4 for b in ids], "ids": ids}
            if decoded:
                out["decoded"] = [coder.decode(np.frombuffer(b, "<u4")) for b in ids]
            return out

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {kind}, n_tokens long, ids binary" + ", decoded string" * decoded
    return map_texts(rows, schema, make, ["doc_id", "text"], ROWS)


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` from packed ids; null ids give an empty text."""
    sent = Sent(tokens.sparkSession, Vocabulary(model))

    def make():
        coder = sent.value.coder()
        return lambda rows: {"doc_id": rows["doc_id"], "text": [coder.decode(np.frombuffer(b or b"", "<u4")) for b in rows["ids"]]}

    kind = tokens.schema[id_col].dataType.simpleString()
    rows = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_texts(rows, f"doc_id {kind}, text string", make, ["doc_id", "ids"])


def digests(encoded: DataFrame) -> DataFrame:
    """What ``op7`` returns, from ``encode(..., decoded=True)``."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
