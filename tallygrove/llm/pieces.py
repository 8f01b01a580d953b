"""SentencePiece encoding and decoding with N-best segmentation.

The lattice of a text has an edge for every vocabulary piece found in it, and byte
pieces for a character that no piece begins at. Forward Viterbi gives each position the
best score of any path to it; a backward A-star search from the end uses those scores
as its heuristic, which is exact, so paths come off the queue in order of total score
and each is final.

No piece crosses from other characters into a space mark, and line feeds have no piece
of their own, so the lattice falls apart at those places. Chunks' best paths and the loss of
their second-best (Viterbi with the two best scores at each position) are remembered; the N best of a text differ from its best only in the N - 1 chunks of least
loss, so only those are searched for N paths, and their sums merged, which is exact.
A search keeps back-pointers, and leaves out what loses more than N paths already known,
so a long text without spaces takes memory in proportion to its length.

Space becomes U+2581 and one more stands at the front; decoding turns them back and
drops the first. Defined results: null text is empty and has no pieces; a text that
holds U+2581 itself decodes to a space in its place; repeated rows each get a row;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import slim

MARK = "▁"
N_BEST = 4
_KNOWN = 350_000
_LONGEST_KNOWN = 48
#: Chunks above this length keep their Viterbi tables packed.
_PACKED = 4096
#: score and ids (little-endian 32-bit) of a chunk's best path, loss of the second-best, place for its N best
Entry = list
Path = tuple[float, bytes]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary with scores, its chunks' N-best lists, encode and decode."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_at: dict[int, int], n_best: int = N_BEST) -> None:
        """pieces by id ('' for one that is no text); bytes_at: byte value to id."""
        self.n_best = n_best
        self.ids = {p: i for i, (p, _) in enumerate(pieces) if p}
        self.scores = [s for _, s in pieces]
        self.longest = max(map(len, self.ids), default=1)
        self.bytes_at = bytes_at
        self.byte_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        self.surface = [p.replace(MARK, " ").encode() for p, _ in pieces]
        for value, i in bytes_at.items():
            self.surface[i] = bytes([value])
            self.scores[i] = self.byte_score
        # a tree of characters: each node is its children and, if a piece ends there, the piece's score
        self.tree: dict = {}
        for p, i in self.ids.items():
            children = self.tree
            for c in p[:-1]:
                children = children.setdefault(c, [{}, None])[0]
            children.setdefault(p[-1], [{}, None])[1] = self.scores[i]
        self.coded = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1) if p[k + 1] in ".,"}
        self.split = re.compile(rf"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
        self.known: dict[str, Entry] = {}
        self.older: dict[str, Entry] = {}

    @classmethod
    def load(cls, path: str, n_best: int = N_BEST) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, bytes_at = [], {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                bytes_at[int(piece[3:5], 16)] = i
            pieces.append(("" if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else piece, sp.get_score(i)))
        return cls(pieces, bytes_at, n_best)

    def edges(self, chunk: str, end: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """The edges that come in at one end position: (begin, score, ids)."""
        out = []
        get, scores = self.ids.get, self.scores
        for a in range(end - 1, max(-1, end - self.longest - 1), -1):
            i = get(chunk[a:end])
            if i is not None:
                out.append((a, scores[i], (i,)))
            elif a == end - 1:
                raw = chunk[a].encode()
                out.append((a, self.byte_score * len(raw), tuple(self.bytes_at[x] for x in raw)))
        return out

    def best(self, chunk: str) -> Entry:
        """Forward Viterbi: the best path, and the loss of the second-best by keeping two scores at each position."""
        n, low = len(chunk), float("-inf")
        one, two, come = [low] * (n + 1), [low] * (n + 1), [0] * (n + 1)
        if n > _PACKED:  # eight bytes a place
            one, two, come = array("d", one), array("d", two), array("q", come)
        one[0] = 0.0
        for a in range(n):
            x, y = one[a], two[a]
            children = self.tree
            b = a
            while b < n:
                node = children.get(chunk[b])
                b += 1
                if node is None:  # no piece begins like this
                    break
                children, s = node
                if s is None:
                    continue
                t = x + s
                if t > one[b]:
                    s += y
                    two[b] = one[b] if one[b] > s else s
                    one[b] = t
                    come[b] = a
                elif t > two[b]:
                    two[b] = t
            node = self.tree.get(chunk[a])
            if node is None or node[1] is None:
                s, b = self.byte_score * len(chunk[a].encode()), a + 1
                if x + s > one[b]:
                    two[b] = max(one[b], y + s)
                    one[b] = x + s
                    come[b] = a
                elif x + s > two[b]:
                    two[b] = x + s
        ids: list[bytes] = []
        b = n
        while b:
            a = come[b]
            own = self.coded.get(chunk[a:b])
            ids.append(own if own is not None else b"".join(self.bytes_at[v].to_bytes(4, "little") for v in chunk[a].encode()))
            b = a
        return [one[n], b"".join(reversed(ids)), one[n] - two[n], None]

    def ahead(self, chunk: str) -> array:
        """Forward Viterbi: the best score of any path to each position."""
        out = array("d", [0.0]) * (len(chunk) + 1)
        for b in range(1, len(out)):
            out[b] = max(out[a] + s for a, s, _ in self.edges(chunk, b))
        return out

    def _bound(self, chunk: str, ahead: array) -> float:
        """A loss that the N-th best path does not exceed.

        Each edge that enters the best path from beside it begins another path, whose loss
        is known; the N - 1 least of them are N - 1 paths beside the best.
        """
        losses: list[float] = []
        b = len(chunk)
        while b:
            into = sorted(((ahead[a] + s, a) for a, s, _ in self.edges(chunk, b)), reverse=True)
            losses = heapq.nsmallest(self.n_best - 1, [*losses, *(into[0][0] - t for t, _ in into[1 : self.n_best])])
            b = into[0][1]
        return losses[-1] if losses and len(losses) == self.n_best - 1 else float("inf")

    def search(self, chunk: str) -> list[Path]:
        """The N best (score, ids), best first, by A-star from the end with Viterbi scores ahead.

        An item is its place and the number of the item it came from, so memory grows with
        the items made and not with their paths; items that lose more than the N-th best can
        are not made. Of equal totals the item nearest to the start goes first, then the
        older one.
        """
        ahead = self.ahead(chunk)
        most = self._bound(chunk, ahead)
        least = ahead[-1] - most - 1e-9 * max(1.0, abs(ahead[-1]))
        out: list[Path] = []
        places, parents = array("q", [len(chunk)]), array("q", [-1])
        queue: list[tuple[float, int, int, float]] = [(-ahead[-1], len(chunk), 0, 0.0)]  # minus the total, place, item, score behind it
        while queue and len(out) < self.n_best:
            _, at, item, score = heapq.heappop(queue)
            if at == 0:
                out.append((score, self._ids(chunk, places, parents, item)))
                continue
            for a, s, _ in self.edges(chunk, at):
                total = ahead[a] + s + score
                if total >= least:
                    heapq.heappush(queue, (-total, a, len(places), score + s))
                    places.append(a)
                    parents.append(item)
        return out

    def _ids(self, chunk: str, places: array, parents: array, item: int) -> bytes:
        """The ids along the back-pointers from an item at the start."""
        ids: list[bytes] = []
        while (up := parents[item]) >= 0:
            a, b = places[item], places[up]
            own = self.coded.get(chunk[a:b])
            ids.append(own if own is not None else b"".join(self.bytes_at[v].to_bytes(4, "little") for v in chunk[a].encode()))
            item = up
        return b"".join(ids)

    def entry(self, chunk: str) -> Entry:
        got = self.known.get(chunk)
        if got is None:
            got = self.older.get(chunk) or self.joined(chunk) or self.best(chunk)
            if len(chunk) <= _LONGEST_KNOWN:
                if len(self.known) >= _KNOWN:
                    self.older, self.known = self.known, {}
                self.known[chunk] = got
        return got

    def joined(self, chunk: str) -> Entry | None:
        """A word and a last full stop or comma that no piece joins: the sum of both."""
        if len(chunk) < 3 or chunk[-1] not in ".," or chunk[-2:] in self.pairs:
            return None
        stem, stop = self.entry(chunk[:-1]), self.entry(chunk[-1])
        return [stem[0] + stop[0], stem[1] + stop[1], min(stem[2], stop[2]), None]

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """The N best segmentations of a whole text: score, and ids as little-endian 32-bit numbers."""
        if not text:
            return [(0.0, b"")]
        chunks = self.split.findall(MARK + text.replace(" ", MARK))
        get, entry = self.known.get, self.entry
        entries = [get(c) or entry(c) for c in chunks]
        first = [e[1] for e in entries]
        total = sum([e[0] for e in entries])
        # the N least losses so far, each with the chunks that do not take their best
        few: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        losses = [e[2] for e in entries]
        for k in heapq.nsmallest(self.n_best - 1, range(len(losses)), key=losses.__getitem__):
            if entries[k][3] is None:
                entries[k][3] = self.search(chunks[k])
            paths = entries[k][3]
            more = ((loss + paths[0][0] - p[0], took + ((k, j),)) for loss, took in few for j, p in enumerate(paths[1:], 1))
            few = sorted([*few, *more])[: self.n_best]
        out = []
        for loss, took in few:
            parts = list(first)
            for k, j in took:
                parts[k] = entries[k][3][j][1]
            out.append((total - loss, b"".join(parts)))
        return out

    def decode(self, ids) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        return raw[1:].decode() if raw[:1] == b" " else raw.decode()


_models: dict[tuple[str, int], Pieces] = {}


def model_of(path: str, n_best: int) -> Pieces:
    """One for each worker process, kept from one task to the next."""
    key = path, n_best
    if key not in _models:
        _models[key] = Pieces.load(path, n_best)
    return _models[key]


def encode_documents(docs: DataFrame, path: str | None = None, n_best: int = N_BEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (the best segmentation), scores and crcs (of the N best, best first: score, crc32 of ids)."""
    rows = slim(docs, doc_id=id_col, text=text_col)
    path = path or default_model()
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = model_of(path, n_best)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, scores, crcs = [], [], []
                for text in part.column(1):
                    paths = model.encode(text.as_py() or "")
                    ids.append(paths[0][1])
                    scores.append([s for s, _ in paths])
                    crcs.append([zlib.crc32(p) for _, p in paths])
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                arrays = [part.column(0), lists, pa.array(scores, pa.list_(pa.float64())), pa.array(crcs, pa.list_(pa.int64()))]
                yield pa.record_batch(arrays, ["doc_id", "ids", "scores", "crcs"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids array<int>, scores array<double>, crcs array<bigint>")


def decode_documents(coded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and text of rows of ids, with the columns of keep."""
    rows = coded.select(coded[id_col].alias("doc_id"), coded[ids_col].alias("ids"), *keep)
    path = path or default_model()
    kinds = [f"doc_id {rows.schema['doc_id'].dataType.simpleString()}", "text string"]
    kinds += [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]

    def run(batches):
        model = model_of(path, N_BEST)
        for batch in batches:
            texts = [model.decode(x.values.to_numpy().tolist() if x.is_valid else ()) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), *batch.columns[2:]], ["doc_id", "text", *keep])

    return rows.mapInArrow(run, ", ".join(kinds))
