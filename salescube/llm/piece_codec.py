"""SentencePiece encoding and decoding with a BPE piece file, by batched Viterbi over numpy arrays.

A text is cut at its spaces; every cut, and the text's start, is the space mark of the word after it. Words are named by 64-bit hashes
over all texts of a piece at once; their ids are gathered from a cache of sorted hashes, and `round_trip` compares the bytes of the ids
with the text, so a word is never silently taken for another. Words not seen lately are encoded together: words of equal length form one matrix of code points and advance together, one position at a time. A polynomial
hash of every substring of up to the longest piece's length probes the sorted hashes of the pieces (hits are verified on the code
points). A prefix ending with piece q extends the best segmentation ending where q starts, whose last piece is p, if merging
would leave p and q side by side; such a segmentation is unique, so the maximum over the lengths of q, stored as backpointer,
gives the very pieces that merging in order of score gives. Whether p and q stay side by side is read off the pieces' own merge
trees, for all candidates of a step at once.

Characters outside the vocabulary become byte pieces. A literal space mark is written as bytes too, so that decoding returns the
text exactly; the original library would return a space. Runs of spaces merge last in these files and are encoded by length.

The piece file is read once on the driver; its tables (about 2 MB for 32,000 pieces) travel with the task.

Defined cases: null and empty texts have no ids; text that is not valid UTF-8 is read with replacement characters and reported by
`round_trip` = false; repeated rows each come back; other columns are kept by `encoded`, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from salescube.llm import tokens

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_LITERAL_MARK = 0x110000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 500_000
_CACHE = ("runs", "names", "places", "counts", "known_ids")
_KEPT: dict[str, dict] = {}
_UNMARKED = np.uint64(0xB492B66FBE98F273)


def _merged(symbols: list[str], rank: dict[str, int]) -> list[tuple[str, str, str]]:
    """Merge the best adjacent pair, leftmost first, until none is a piece; returns (piece, left part, right part) of what stays."""
    parts = [(s, "", "") for s in symbols]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(rank[a + b], i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or parts[i][0] != a or j >= len(parts) or parts[j] is None or parts[j][0] != b:
            continue
        parts[i], parts[j] = (a + b, a, b), None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < len(parts):
                x, y = parts[left][0], parts[right][0]
                if x + y in rank:
                    heapq.heappush(heap, (rank[x + y], left, x, y))
    return [p for p in parts if p is not None]


class Pieces:
    """Tables of one piece file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.key = hashlib.sha256(model).hexdigest()
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only BPE piece files that leave the text as it is and mark its start are supported")
        kinds = proto.ModelProto.SentencePiece
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == kinds.UNKNOWN)
        normal = [i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL]
        text = [p.piece for p in spec.pieces]
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kinds.BYTE}
        if len(self.byte_ids) != 256:
            raise ValueError("the piece file has no byte pieces")
        self.of_byte = np.array([self.byte_ids[b] for b in range(256)], np.int32)
        runs = {text[i]: i for i in normal if set(text[i]) == {MARK}}
        words = [i for i in normal if len(text[i]) == 1 or text[i] not in runs]
        if any(MARK in text[i][1:] for i in words) or max(spec.pieces[i].score for k, i in runs.items() if len(k) == 2) >= min(spec.pieces[i].score for i in words if len(text[i]) > 1):
            raise ValueError("space marks inside pieces, or merged before words, are not supported")

        by_score = sorted(words, key=lambda i: (len(text[i]) > 1, -spec.pieces[i].score, i))
        rank = {text[i]: r for r, i in enumerate(by_score)}
        merges = {w: r for w, r in rank.items() if len(w) > 1}
        trees = [_merged(list(text[i]), merges) for i in by_score]
        reached = [len(t) == 1 for t in trees]
        #: By rank: the piece's id, and the ranks of its two parts (its own for a single character).
        self.ids = np.array(by_score, np.int32)
        self.left = np.array([rank[t[0][1]] if ok and t[0][1] else r for r, (t, ok) in enumerate(zip(trees, reached))], np.int64)
        self.right = np.array([rank[t[0][2]] if ok and t[0][2] else r for r, (t, ok) in enumerate(zip(trees, reached))], np.int64)
        merged = np.flatnonzero((self.left != np.arange(len(by_score))) & reached)
        keys = self.left[merged] << 32 | self.right[merged]
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], merged[order]

        self.longest = max(len(text[i]) for i in words)
        self.points = np.zeros((len(by_score), self.longest), np.int64)
        self.sizes = np.array([len(text[i]) for i in by_score])
        for r, i in enumerate(by_score):
            self.points[r, :self.sizes[r]] = [ord(c) for c in text[i]]
        hashes = _substring_hashes(self.points, self.sizes)
        usable = np.flatnonzero(reached)
        order = usable[np.argsort(hashes[usable])]
        self.hash_keys, self.hash_ranks = hashes[order], order
        if len(np.unique(self.hash_keys)) != len(order):
            raise ValueError("two pieces share a hash")
        self.hash_tops = np.zeros(1 << 20, bool)
        self.hash_tops[(self.hash_keys >> np.uint64(44)).astype(np.int64)] = True
        inner = np.arange(self.longest - 1) < self.sizes[:, None] - 1
        self.joined = np.unique((self.points[:, :-1] << 21 | self.points[:, 1:])[inner])
        pairs = np.arange(128)[:, None] << 21 | np.arange(128)
        self.parted = np.zeros((256, 256), bool)
        self.parted[:128, :128] = ~np.isin(pairs, self.joined)
        self.parted[32, :] = self.parted[:, 32] = False

        self.run_rank = {k: r for r, k in enumerate(sorted((k for k in runs if len(k) > 1), key=lambda k: (-spec.pieces[runs[k]].score, 0)))}
        tied = {}
        for k in self.run_rank:
            self.run_rank[k] = tied.setdefault(spec.pieces[runs[k]].score, self.run_rank[k])
        self.run_ids = runs
        data = [b"" if p.type == kinds.CONTROL else b" \xe2\x81\x87 " if p.type == kinds.UNKNOWN else bytes([int(p.piece[3:5], 16)])
                if p.type == kinds.BYTE else p.piece.replace(MARK, " ").encode() for p in spec.pieces]
        self.out_sizes = np.array([len(d) for d in data], np.int64)
        self.out_starts = np.cumsum(self.out_sizes) - self.out_sizes
        self.out_bytes = np.frombuffer(b"".join(data), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Empty the cache: words by their sorted hashes, with the place and number of their ids."""
        self.runs: dict[int, np.ndarray] = {}
        self.names, self.places, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known_ids = np.zeros(0, np.int32)

    def keep(self) -> None:
        """Leave the cache to the next task of this worker; one piece file's cache is kept."""
        _KEPT.clear()
        _KEPT[self.key] = {c: self.__dict__[c] for c in _CACHE}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in _CACHE}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()
        self.__dict__.update(_KEPT.get(self.key, {}))

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pieces of these ranks stay side by side when their characters are merged together."""
        out = np.ones(len(left), bool)
        live = np.flatnonzero((left < len(self.ids)) & (right < len(self.ids)))
        a, b = left[live], right[live]
        limit = np.full(len(live), 1 << 40)
        while len(live):
            key = a << 32 | b
            at = np.searchsorted(self.pair_keys, key)
            at[at == len(self.pair_keys)] = 0
            joins = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit)
            out[live[joins]] = False
            a_parts, b_parts = self.right[a], self.left[b]
            a_whole, b_whole = a_parts == a, b_parts == b
            open_left = np.where(a > b, ~a_whole, b_whole & ~a_whole)
            open_right = ~open_left & ~b_whole
            limit = np.where(open_left, a, b + 1)
            a, b = np.where(open_left, a_parts, a), np.where(open_right, b_parts, b)
            on = ~joins & (open_left | open_right)
            live, a, b, limit = live[on], a[on], b[on], limit[on]
        return out

    def _segment(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length (rows of code points): rank and length of the last piece of every prefix."""
        rows, n = points.shape
        last = np.full((rows, n + 1), len(self.ids), np.int64)
        back = np.ones((rows, n + 1), np.int8)
        prefix, inverse = _prefix_hashes(points)
        found = []
        for size in range(1, min(self.longest, n) + 1):
            keys = tokens.mix((prefix[:, size:] - prefix[:, :n - size + 1]) * inverse[:n - size + 1] + np.uint64(size))
            row, place = np.nonzero(self.hash_tops[(keys >> np.uint64(44)).astype(np.int64)])
            keys = keys[row, place]
            at = np.searchsorted(self.hash_keys, keys)
            at[at == len(self.hash_keys)] = 0
            hit = np.flatnonzero(self.hash_keys[at] == keys)
            row, place, ranks = row[hit], place[hit], self.hash_ranks[at[hit]]
            real = (self.sizes[ranks] == size) & (self.points[ranks, :size] == points[row[:, None], place[:, None] + np.arange(size)]).all(axis=1)
            found.append((row[real], ranks[real], place[real], place[real] + size))
        row, ranks, begins, ends = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(ends, kind="stable")
        row, ranks, begins = row[order], ranks[order], begins[order]
        cuts = np.searchsorted(ends[order], np.arange(n + 2))
        for end in range(1, n + 1):
            here = slice(cuts[end], cuts[end + 1])
            fits = np.flatnonzero(self.apart(last[row[here], begins[here]], ranks[here])) + cuts[end]
            last[row[fits], end], back[row[fits], end] = ranks[fits], end - begins[fits]
        return last, back

    def _read(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follow the backpointers from the end; characters without a piece become bytes. Ids of all rows, and how many each has."""
        last, back = self._segment(points)
        rows, n = points.shape
        every, at = np.arange(rows), np.full(rows, n)
        steps = []
        while at.any():
            live = at > 0
            steps.append((np.where(live, last[every, at], -1), at - 1))
            at = np.where(live, at - back[every, at], 0)
        chosen, place = (np.stack(x[::-1], axis=1) for x in zip(*steps))
        row, step = np.nonzero(chosen >= 0)
        ranks, point = chosen[row, step], points[row, place[row, step]]
        known = ranks < len(self.ids)
        point = np.where(point == _LITERAL_MARK, ord(MARK), point)
        sizes = np.where(known, 1, 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
        ids = np.repeat(np.where(known, self.ids[np.where(known, ranks, 0)], -1), sizes).astype(np.int32)
        strange = np.flatnonzero(ids < 0)
        if len(strange):
            data = np.frombuffer("".join(map(chr, point[~known].tolist())).encode("utf-8"), np.uint8)
            ids[strange] = self.of_byte[data]
        return ids, np.bincount(row, sizes, rows).astype(np.int64)

    def _encoded(self, words: list[str], marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words (those `marked` with their space mark in front), end to end, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + marked
        starts = np.cumsum(sizes) - sizes
        points = np.frombuffer("".join([MARK + w if m else w for w, m in zip(words, marked.tolist())]).encode("utf-32-le"), np.uint32).astype(np.int64)
        literal = points == ord(MARK)
        literal[starts[marked]] = False
        points[literal] = _LITERAL_MARK
        # no piece reaches over two characters that are side by side in none, so words are cut there
        pair = points[:-1] << 21 | points[1:]
        at = np.searchsorted(self.joined, pair)
        at[at == len(self.joined)] = 0
        cut = np.r_[True, self.joined[at] != pair]
        cut[starts] = True
        begins = np.flatnonzero(cut)
        lengths = np.diff(np.r_[begins, len(points)])
        prefix, inverse = _prefix_hashes(points[None, :])
        names = (prefix[0, begins + lengths] - prefix[0, begins]) * inverse[begins] + lengths.astype(np.uint64)
        _, first, back = np.unique(names, return_index=True, return_inverse=True)
        begins, lengths = begins[first], lengths[first]
        held, counts, owners = [], [], []
        for size in np.unique(lengths).tolist():
            units = np.flatnonzero(lengths == size)
            step = max(1, (1 << 18) // size)
            for i in range(0, len(units), step):
                now = units[i:i + step]
                ids, n = self._read(points[begins[now][:, None] + np.arange(size)])
                held.append(ids)
                counts.append(n)
                owners.append(now)
        held, counts, owners = np.concatenate(held), np.concatenate(counts), np.concatenate(owners)
        offsets, total = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        offsets[owners], total[owners] = np.cumsum(counts) - counts, counts
        flat = held[np.repeat(offsets[back], total[back]) + tokens.ramp(total[back])]
        ends = np.cumsum(total[back])
        return flat, np.diff(ends[np.searchsorted(np.flatnonzero(cut), starts + sizes) - 1], prepend=0)

    def _spaces(self, count: int) -> np.ndarray:
        """Ids of `count` space marks in a row."""
        if count not in self.runs:
            self.runs[count] = np.array([self.run_ids[p[0]] for p in _merged([MARK] * count, self.run_rank)], np.int32) if count else np.zeros(0, np.int32)
        return self.runs[count]

    def _lookup(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of these words lie in `known_ids`, and how many there are; words not seen lately are encoded first."""
        names = tokens.word_hashes(raw, starts, ends)
        names[~marked] = tokens.mix(names[~marked] ^ _UNMARKED)
        names, first, back = np.unique(names, return_index=True, return_inverse=True)
        at = np.searchsorted(self.names, names)
        at[at == len(self.names)] = 0
        new = np.flatnonzero(self.names[at] != names) if len(self.names) else np.arange(len(names))
        if len(new):
            data = raw.tobytes()
            words = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            flat, counts = self._encoded(words, marked[first[new]])
            if len(self.names) + len(new) > _CACHED_WORDS:  # only this piece's words stay
                stay = np.delete(at, new)
                sizes = self.counts[stay]
                self.known_ids = self.known_ids[np.repeat(self.places[stay], sizes) + tokens.ramp(sizes)]
                self.names, self.places, self.counts = self.names[stay], np.cumsum(sizes) - sizes, sizes
            merged = np.concatenate([self.names, names[new]])
            order = np.argsort(merged, kind="stable")
            self.places = np.concatenate([self.places, len(self.known_ids) + np.cumsum(counts) - counts])[order]
            self.names, self.counts = merged[order], np.concatenate([self.counts, counts])[order]
            self.known_ids = np.concatenate([self.known_ids, flat])
            at = np.searchsorted(self.names, names)
        return self.places[at[back]], self.counts[at[back]]

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts raw[offs[i]:offs[i + 1]], end to end, and where each text's ids start (one entry more than texts)."""
        blanks = np.flatnonzero(raw == 32)
        begun = np.flatnonzero(np.diff(offs))
        # no piece reaches over two characters that are side by side in none, so words are cut between such letters and signs, too
        inner = self.parted[raw[:-1], raw[1:]] if len(raw) else np.zeros(0, bool)
        inner[offs[(offs > 0) & (offs < len(raw))] - 1] = False
        cuts = np.flatnonzero(inner) + 1
        starts, ends = np.sort(np.r_[offs[begun], blanks + 1, cuts]), np.sort(np.r_[blanks, offs[begun + 1], cuts])
        marked = ~np.r_[False, inner, False][starts] if len(starts) else np.zeros(0, bool)
        per_text = np.diff(np.searchsorted(blanks, offs) + np.searchsorted(cuts, offs))
        per_text[begun] += 1
        text = np.repeat(np.arange(len(per_text)), per_text)
        full = ends > starts
        place, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if full.any():
            place[full], count[full] = self._lookup(raw, starts[full], ends[full], marked[full])
        extra = {}
        if not full.all():  # runs of spaces: one mark for each empty word, with the next word's own mark if that stands alone
            alone = np.zeros(len(starts), bool)
            alone[full] = self.known_ids[place[full]] == self.run_ids[MARK]
            empty = np.flatnonzero(~full)
            last = np.r_[(np.diff(empty) > 1) | (np.diff(text[empty]) > 0), True]
            length = np.diff(np.flatnonzero(last), prepend=-1)
            for at, run in zip(empty[last].tolist(), length.tolist()):
                follows = at + 1 < len(starts) and text[at + 1] == text[at] and alone[at + 1]
                extra[at] = self._spaces(run + int(follows))
                count[at] = len(extra[at])
                if follows:
                    place[at + 1] += 1
                    count[at + 1] -= 1
        out_at = np.cumsum(count) - count
        words = np.where(full, count, 0)
        flat = np.zeros(int(count.sum()), np.int32)
        flat[np.repeat(out_at, words) + tokens.ramp(words)] = self.known_ids[np.repeat(place, words) + tokens.ramp(words)]
        for at, ids in extra.items():
            flat[out_at[at]:out_at[at] + len(ids)] = ids
        sums = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=sums[1:])
        return flat, sums[np.r_[0, np.cumsum(per_text)]]

    def _bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, and where those of each begin (one entry more than ids)."""
        sizes = self.out_sizes[ids]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        return self.out_bytes[np.repeat(self.out_starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def returns(self, ids: np.ndarray, at: np.ndarray, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Whether decoding gives the very bytes of each text."""
        data, ends = self._bytes(ids)
        cuts, sizes = ends[at], np.diff(offs)
        some = sizes > 0
        same = np.diff(cuts) == sizes + some  # a space stands before the first word
        if same.all():
            wanted = np.full(len(data), 32, np.uint8)
            wanted[np.arange(len(raw)) + np.repeat(np.cumsum(some), sizes)] = raw
            wrong = np.flatnonzero(data != wanted)
            same[np.searchsorted(cuts, wrong, side="right") - 1] = False
            return same
        return np.array([ok and data[a:b].tobytes().removeprefix(b" ") == raw[c:d].tobytes()
                         for ok, a, b, c, d in zip(same, cuts, cuts[1:], offs, offs[1:])], bool)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """UTF-8 of the texts with ids[at[i]:at[i + 1]]."""
        data, ends = self._bytes(ids)
        data, cuts = data.tobytes(), ends[at].tolist()
        return [data[a:b].removeprefix(b" ") for a, b in zip(cuts, cuts[1:])]


def _prefix_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash sums of the prefixes of each row, and the inverse powers that move a difference of two to the row's start."""
    powers, inverse = tokens._powers_to(int(_BASE), points.shape[1] + 1)
    prefix = np.zeros((len(points), points.shape[1] + 1), np.uint64)
    np.cumsum(tokens.mix(points.astype(np.uint64) + np.uint64(1)) * powers[:points.shape[1]], axis=1, out=prefix[:, 1:])
    return prefix, inverse


def _substring_hashes(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of the first `sizes` code points of each row."""
    prefix, _ = _prefix_hashes(points)
    return tokens.mix(prefix[np.arange(len(points)), sizes] + sizes.astype(np.uint64))


def load(path: str = MODEL_FILE) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read())


def encoded(documents: DataFrame, pieces: Pieces) -> DataFrame:
    """The documents with three more columns: n_tokens, token_ids, round_trip (decoding the ids gives the text's bytes)."""
    own = documents.columns
    width = len(own)
    names = ["n_tokens", "token_ids", "round_trip"]
    while set(names) & {c.lower() for c in own}:
        names = [n + "_" for n in names]

    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            flat, at = pieces.encode(raw, offs)
            same = pieces.returns(flat, at, raw, offs)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:width], pa.array(np.diff(at).astype(np.int32)), lists, pa.array(same)], names=[*own, *names])
        pieces.keep()

    added = [StructField(n, t) for n, t in zip(names, (IntegerType(), ArrayType(IntegerType()), BooleanType()))]
    return documents.mapInArrow(run, StructType([*documents.schema.fields, *added]))


def decoded(encodings: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id and text of rows with doc_id and token_ids."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1).fill_null(pa.scalar([], batch.column(1).type)) if batch.column(1).null_count else batch.column(1)
            at = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
            texts = [b.decode("utf-8", "replace") for b in pieces.decode(flat, at - at[0])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encodings.select("doc_id", F.col("token_ids").cast("array<int>")).mapInArrow(
        run, StructType([encodings.schema["doc_id"], StructField("text", encodings.sparkSession.createDataFrame([], "s string").schema["s"].dataType)]))


def op7_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Piece ids of all documents."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), load())
