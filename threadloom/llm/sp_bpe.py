"""Operator 9: SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda of adjacent symbol pairs.

A text is cut into words that no piece of the vocabulary spans (a text is one word if some piece does). All distinct words of an
Arrow batch work off their agendas together: in each round every word merges its best adjacent pair (highest score, then leftmost),
and only the pairs beside the merge are scored anew. Words of more than LONG letters (texts without blanks) have a heap over linked
symbols each.

The library checks the agenda: it normalises every whole text, and encodes every distinct word when the worker first meets it, many of
them strung together. As no piece spans words, a text's ids are its words' ids. A string whose ids differ casts doubt on its words, and a
text with a word in doubt is encoded whole by the library too, as is the first text of each slice in any case; where its ids are
others, they are what is returned, and `agrees` is false. So `agrees` says that all words of the text agree, or the whole text.

Cases: a null or empty text has the end id alone and decodes to the empty text; repeated rows are encoded each; pairs of one score
merge from the left; a very long text is a slice of its own; rows with a null doc_id are left out; characters that are in no piece
become bytes; other columns, whatever their names, are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bound_batches, byte_view, docs_of, give_back, ragged, slices

#: What the library puts for a space.
BLANK = "▁"
#: Bytes of text whose distinct words are worked off together.
SLICE = 6 << 20
#: Words that a worker remembers the ids of.
REMEMBERED = 150_000
#: Bytes of text whose ids are held as lists at a time.
PART = 1 << 20
#: Letters from which a word has an agenda of its own.
LONG = 128
#: Letters of the strings of words that the library is asked for.
STRING = 1 << 15


class Agenda:
    """An encoder for one model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = lib.get_piece_size()
        self.end = lib.eos_id()
        self.bytes = {}
        ids: dict[str, int] = {}
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                ids[piece] = i
        self.ids, self.size = ids, n
        pairs = {}
        for piece, i in ids.items():
            for k in range(1, len(piece)):
                if piece[:k] in ids and piece[k:] in ids:
                    pairs[ids[piece[:k]] * n + ids[piece[k:]]] = i
        self.pairs = pairs
        # words met before: their numbers, and by number where their ids begin and how many these are
        self.known: dict[str, int] = {}
        self.known_ids, self.known_at, self.known_n = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self._hash_pairs(pairs)
        # the agenda's order: scores, best first, as whole numbers
        scores = np.array([lib.get_score(i) for i in range(n)])
        self.order = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        #: Cutting at blanks is right if no piece has a blank after another character; else a text is one word.
        self.inner = any(BLANK in p.lstrip(BLANK) for p in ids)

    def _hash_pairs(self, pairs: dict[int, int], bits: int = 20) -> None:
        """One slot for a pair; the few pairs whose slot is taken are in a sorted list beside the table."""
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, dtype=np.int64)
        self.made = np.full(1 << bits, -1, dtype=np.int32)
        self.crowded = np.zeros(1 << bits, dtype=bool)
        over = {}
        for key, piece in sorted(pairs.items()):
            at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - bits
            if self.slots[at] < 0:
                self.slots[at], self.made[at] = key, piece
            else:
                self.crowded[at] = True
                over[key] = piece
        self.over = np.array(sorted(over), dtype=np.int64)
        self.over_made = np.array([over[k] for k in self.over.tolist()], dtype=np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two neighbours make, or -1."""
        key = np.where((a >= 0) & (b >= 0), a * self.size + b, -2)
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        hit = self.slots[at] == key
        out = np.where(hit, self.made[at], -1).astype(np.int64)
        if len(self.over) and len(rest := np.flatnonzero(self.crowded[at] & ~hit)):
            k = np.minimum(np.searchsorted(self.over, key[rest]), len(self.over) - 1)
            out[rest] = np.where(self.over[k] == key[rest], self.over_made[k], -1)
        return out

    def work_off(self, word: str) -> np.ndarray:
        """Ids of one word, by a heap of its adjacent pairs (best score, then leftmost) over linked symbols: its time follows the word's length, up to a logarithm."""
        n, pairs, order = self.size, self.pairs, self.order.tolist()
        symbols = [self.ids.get(c, -2 - ord(c)) for c in word]
        last = len(symbols)
        before, after = list(range(-1, last - 1)), list(range(1, last + 1))
        made = [-1] * last

        def meet(i: int, j: int) -> int:
            a, b = symbols[i], symbols[j]
            made[i] = piece = pairs.get(a * n + b, -1) if a >= 0 and b >= 0 else -1
            return piece

        agenda_ = [order[p] << 40 | i for i in range(last - 1) if (p := meet(i, i + 1)) >= 0]
        heapq.heapify(agenda_)
        while agenda_:
            entry = heapq.heappop(agenda_)
            i = entry & (1 << 40) - 1
            piece = made[i]
            if piece < 0 or order[piece] != entry >> 40:
                continue  # its symbols are others by now
            j = after[i]
            symbols[i], symbols[j] = piece, None
            made[i] = made[j] = -1
            after[i] = k = after[j]
            if k < last:
                before[k] = i
                if (p := meet(i, k)) >= 0:
                    heapq.heappush(agenda_, order[p] << 40 | i)
            if (h := before[i]) >= 0 and (p := meet(h, i)) >= 0:
                heapq.heappush(agenda_, order[p] << 40 | h)
        out: list[int] = []
        for x in symbols:
            if x is not None:
                out += [x] if x >= 0 else [self.bytes[c] for c in chr(-2 - x).encode()]
        return np.array(out, dtype=np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each: words up to LONG letters all together, longer ones by a heap each."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self._together(words)
        flat, some = self._together([w for w in words if len(w) <= LONG])
        found = {i: self.work_off(words[i]) for i in long}
        short = np.ones(len(words), dtype=bool)
        short[long] = False
        lengths = np.zeros(len(words), dtype=np.int64)
        lengths[short], lengths[long] = some, [len(found[i]) for i in long]
        at = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), dtype=np.int64)
        out[ragged(at[short], some)] = flat
        for i, ids in found.items():
            out[at[i] : at[i] + len(ids)] = ids
        return out, lengths

    def encode_distinct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As encode_words, for different words, and which of them are in doubt: those of earlier slices are looked up, the first REMEMBERED ones of a worker that were in none."""
        place = np.fromiter((self.known.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        old = place >= 0
        fresh = [words[i] for i in np.flatnonzero(~old).tolist()]
        ids, some = self.encode_words(fresh)
        odd = self.doubtful(fresh, ids, some)
        doubt = np.zeros(len(words), dtype=bool)
        doubt[~old] = odd
        lengths = np.empty(len(words), dtype=np.int64)
        lengths[~old], lengths[old] = some, self.known_n[place[old]]
        at = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), dtype=np.int64)
        out[ragged(at[~old], some)] = ids
        out[ragged(at[old], lengths[old])] = self.known_ids[ragged(self.known_at[place[old]], lengths[old])]
        keep = np.array([i for i, w in enumerate(fresh[: max(0, REMEMBERED - len(self.known))]) if len(w) <= LONG and not odd[i]], dtype=np.int64)
        if len(keep):
            self.known.update((fresh[i], len(self.known_n) + k) for k, i in enumerate(keep.tolist()))
            first = np.cumsum(some) - some
            self.known_at = np.r_[self.known_at, len(self.known_ids) + np.cumsum(some[keep]) - some[keep]]
            self.known_n = np.r_[self.known_n, some[keep]]
            self.known_ids = np.r_[self.known_ids, ids[ragged(first[keep], some[keep])]]
        return out, lengths, doubt

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end, and the number of ids of each: every word's agenda goes one merge on in each round."""
        text = "".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        letters, inverse = np.unique(codes, return_inverse=True)
        # characters without a piece get ids below -1, and bytes at the end
        of = np.array([self.ids.get(chr(c), -2 - int(c)) for c in letters.tolist()], dtype=np.int64)
        symbols = of[inverse] if len(codes) else np.zeros(0, dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owner, done_rank = [], [], []
        rank = np.arange(len(symbols))
        never = np.int64(1) << 40
        made = np.full(len(symbols), -1, dtype=np.int64)
        if len(symbols) > 1:
            made[:-1] = np.where(owner[1:] == owner[:-1], self.pair(symbols[:-1], symbols[1:]), -1)
        while len(symbols):
            cost = np.where(made >= 0, self.order[made], never)
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(cost, heads)
            counts = np.diff(np.r_[heads, len(symbols)])
            keep = np.repeat(best < never, counts)
            done_symbols.append(symbols[~keep])
            done_owner.append(owner[~keep])
            done_rank.append(rank[~keep])
            # the leftmost of the best pairs in each word
            hit = np.flatnonzero((cost == np.repeat(best, counts)) & keep)
            if not len(hit):
                break
            first = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]]
            symbols[first] = made[first]
            keep[first + 1] = False
            at = (np.cumsum(keep) - 1)[first]
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            # only the pairs on either side of a merge are new
            last = len(symbols) - 1
            right = np.minimum(at + 1, last)
            made[at] = np.where((at < last) & (owner[right] == owner[at]), self.pair(symbols[at], symbols[right]), -1)
            left = at[(at > 0) & (owner[np.maximum(at - 1, 0)] == owner[at])] - 1
            made[left] = self.pair(symbols[left], symbols[left + 1])
        if done_symbols:
            symbols, owner, rank = map(np.concatenate, (done_symbols, done_owner, done_rank))
        back = np.argsort(rank, kind="stable")
        symbols, owner = symbols[back], owner[back]
        if len(strange := np.flatnonzero(symbols < 0)):
            spelled = [[self.bytes[x] for x in chr(-2 - s).encode()] for s in symbols[strange].tolist()]
            reps = np.ones(len(symbols), dtype=np.int64)
            reps[strange] = [len(x) for x in spelled]
            owner = np.repeat(owner, reps)
            wide = np.repeat(symbols, reps)
            wide[ragged((np.cumsum(reps) - reps)[strange], reps[strange])] = [x for s in spelled for x in s]
            symbols = wide
        return symbols, np.bincount(owner, minlength=len(words))

    def doubtful(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which of the words the library may encode otherwise: it is asked for all of them, strung together as in a text, and a string whose
        ids differ casts doubt on all its words."""
        out = np.zeros(len(words), dtype=bool)
        ends = np.cumsum(lengths)
        size = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        # blanks at a word's end would join those of the next
        apart = np.fromiter((w.endswith(BLANK) for w in words[:-1]), dtype=bool, count=max(0, len(words) - 1))
        cuts = [0, *(np.flatnonzero((np.diff(size // STRING) > 0) | apart) + 1).tolist(), len(words)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            text = "".join(words[a:z])
            mine = ids[ends[a] - lengths[a] : ends[z - 1]].tolist() if z > a else []
            out[a:z] = not text.startswith(BLANK) or self.library.encode(text[1:].replace(BLANK, " ")) != mine
        return out

    def checked(self, texts: list[str], lists: list[list[int]], ask: list[bool]) -> tuple[list[list[int]], list[bool]]:
        """The lists, and whether the library agrees. It is asked for the whole texts that `ask` marks, and its ids stand in where a list differs."""
        at = [i for i, x in enumerate(ask) if x]
        lists, same = list(lists), [True] * len(lists)
        for i, theirs in zip(at, self.library.encode([texts[i] for i in at], add_eos=True, num_threads=1) if at else (), strict=True):
            same[i] = lists[i] == theirs
            lists[i] = lists[i] if same[i] else theirs
        return lists, same

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end (each with the end id), where each text's begin, and which texts hold a word in doubt.

        Words start where a run of blanks starts; equal words of the batch are worked off once.
        """
        data, offsets = byte_view(texts)
        raw = data.tobytes()
        normal = [self.library.normalize(raw[a:b].decode()) if b > a else "" for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        data, offsets = byte_view(pa.array(normal, pa.large_string()))
        # a blank is three bytes; a cut lies before each blank that follows no blank
        n = len(data)
        blank = np.zeros(n, dtype=bool)
        if n > 2:
            blank[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        cut = blank.copy()
        cut[3:] &= ~blank[:-3]
        cut &= not self.inner
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.r_[starts, n].astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
        which = words.indices.to_numpy()
        names = words.dictionary.to_pylist()
        ids, lengths, doubtful = self.encode_distinct(names)
        at = np.cumsum(lengths) - lengths
        sizes = lengths[which] if len(which) else np.zeros(0, dtype=np.int64)
        flat = ids[ragged(at[which], sizes)] if len(which) else np.zeros(0, dtype=np.int64)
        first = np.searchsorted(starts, offsets)
        ends = np.r_[0, np.cumsum(sizes)][first]
        out = np.insert(flat, ends[1:], self.end)
        doubt = np.diff(np.r_[0, np.cumsum(doubtful[which])][first]) > 0
        return out, ends + np.arange(len(ends)), doubt


@lru_cache(2)
def agenda(model_file: str) -> Agenda:
    return Agenda(model_file)


def _encoded(batches, coder: Agenda):
    """Parts of the batches with the lists of ids of their texts and whether the library agrees. Agendas are worked off for
    SLICE bytes together; lists of numbers are made of PART bytes at a time, as they are large."""
    for whole in batches:
        for b in slices(whole, most=SLICE):
            ids, at, doubt = coder.encode(b.column(1))
            doubt[:1] = True  # a slice's first text is always compared
            row = 0
            for part in slices(b, most=PART):
                cuts, ask = at[row : row + part.num_rows + 1], doubt[row : row + part.num_rows].tolist()
                row += part.num_rows
                lists = [x.tolist() for x in np.split(ids[cuts[0] : cuts[-1]], cuts[1:-1] - cuts[0])]
                texts = part.column(1)
                yield part, *coder.checked([(texts[i].as_py() or "") if x else "" for i, x in enumerate(ask)], lists, ask)


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, ids (with the end id), decoded text, and whether the library's ids are the same."""
    bound_batches(docs.sparkSession, 16)

    def run(batches):
        coder = agenda(model_file)
        for b, lists, same in _encoded(batches, coder):
            decoded = coder.library.decode(lists, num_threads=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "decoded", "agrees"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>, decoded string, agrees boolean")


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agrees: the digests of round_trip, made where the ids are."""
    bound_batches(docs.sparkSession, 16)

    def run(batches):
        coder = agenda(model_file)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b, lists, same in _encoded(batches, coder):
            decoded = coder.library.decode(lists, num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in lists], pa.int64()), pa.array([sha(str(x)[1:-1].replace(",", "").encode()) for x in lists], pa.string()), pa.array([sha(x.encode()) for x in decoded], pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"],
            )
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean")


def sentencepiece_digest(documents: DataFrame, model_file: str) -> DataFrame:
    return digest(docs_of(documents), model_file)
