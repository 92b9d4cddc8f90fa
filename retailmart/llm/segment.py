"""N-best segmentation into the pieces of a SentencePiece vocabulary, and decoding.

The pieces of a text form a lattice; a path's score is the sum of its pieces'. Forward Viterbi gives for every
place the best score of the text before it. That is the exact rest of a path built from the
end, so a backward A-star search with it as heuristic takes paths off its heap in order of score, the best N first.

No piece joins words or lines, so a word, with the blanks before it, has a lattice of its own. A task remembers words
up to a bound: best path, its score, and the loss of the second path, which forward scores tell. The N best paths of a
text exchange words of its best one, in order of loss. Only the N - 1 words whose second path loses least can take
part; for these the search is run. Ties are settled by place.

Characters outside the vocabulary become their UTF-8 bytes' pieces. As the vocabulary's scores are merge ranks, a
piece scores minus the logarithm of its rank, as word frequencies fall, and a byte as the last rank, times two.

Defined results: NULL counts as empty; an empty text has one path without pieces and score 0; a text with fewer than N
paths has fewer; repeated rows are segmented alike; an empty table gives an empty result. Decoding gives back
the text exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEST = 4
BLANK = "▁"
_LITERAL = "\udce2"  # stands for a blank mark that is in the text itself; no valid text holds it
_WORD = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n")  # a word begins at a blank; a line break joins nothing
_CACHE = 800_000
UNIT = 1_000_000  # scores are whole numbers of this unit inside, so that sums and ties are exact
_NEVER = -(1 << 62)


class Vocabulary:
    """Pieces with ids and scores, read from a model file by the library; ``model`` is the file's bytes."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces: dict[str, tuple[tuple[int, ...], int]] = {}
        self.bytes: dict[int, int] = {}
        self.text: list[bytes] = []
        ids = range(read.vocab_size())
        last = round(2 * UNIT * math.log(len(ids) + 1))
        for i in ids:
            piece = read.id_to_piece(i)
            if read.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif read.is_control(i) or read.is_unknown(i):
                self.text.append(b"")
            else:
                rank = 2 - read.get_score(i)
                self.pieces[piece] = ((i,), -round(UNIT * math.log(rank)) if rank < 1e8 else -last)
                self.text.append(piece.replace(BLANK, " ").encode())
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.pieces):
            raise ValueError("a piece joins words or lines, which are segmented one by one")
        self.byte_score = -last
        self.longest = max(map(len, self.pieces))
        #: every beginning of a piece, with the piece itself where it is one
        self.heads: dict[str, tuple | None] = {p[:n]: None for p in self.pieces for n in range(1, len(p))}
        self.heads.update(self.pieces)
        #: all pieces that end at a place, longest first; a character that only stands inside pieces, as its bytes
        self.found = ahocorasick.Automaton()
        for char in {c for p in self.pieces for c in p} - self.pieces.keys():
            self.found.add_word(char, (1, self.spelled(char)))
        for piece, known in self.pieces.items():
            self.found.add_word(piece, (len(piece), known))
        self.found.make_automaton()

    def spelled(self, char: str) -> tuple[tuple[int, ...], int]:
        """A character outside the vocabulary as bytes."""
        raw = BLANK.encode() if char == _LITERAL else char.encode("utf-8", "surrogatepass")
        return tuple(self.bytes[b] for b in raw), len(raw) * self.byte_score

    def lattice(self, word: str) -> tuple[list, list[int]]:
        """For each place the arcs ``(start, piece)`` that end there, and the forward scores."""
        n = len(word)
        arcs: list[list] = [[] for _ in range(n + 1)]
        forward = [0] + [_NEVER] * n
        for start in range(n):
            found = [] if word[start] in self.pieces else [(start + 1, self.spelled(word[start]))]
            for end in range(start + 1, min(n, start + self.longest) + 1):
                known = self.heads.get(word[start:end], 0)
                if known == 0:
                    break
                if known:
                    found.append((end, known))
            for end, piece in found:
                arcs[end].append((start, piece))
                forward[end] = max(forward[end], forward[start] + piece[1])
        return arcs, forward

    def best(self, word: str) -> tuple[int, list[int], int]:
        """Score and pieces of the best path, and what the second one loses; ``-_NEVER`` if there is none.

        Seen from the end, a path leaves the best one by an arc into a place of the best one. So the least
        loss is that of the second best arc into such a place.
        """
        n = len(word)
        forward, second, last = [0] * (n + 1), [_NEVER] * (n + 1), [None] * (n + 1)
        done = 0
        for end, arc in self.found.iter(word):
            end += 1
            if end != done:
                if end - 1 != done:
                    self._spell(word, done, end - 1, forward, last)
                # the first piece that ends here
                done, last[end] = end, arc
                forward[end] = forward[end - arc[0]] + arc[1][1]
                continue
            score = forward[end - arc[0]] + arc[1][1]
            if score > forward[end]:
                second[end], forward[end], last[end] = forward[end], score, arc
            elif score > second[end]:
                second[end] = score
        if done != n:
            self._spell(word, done, n, forward, last)
        ids, place, loss = [], n, -_NEVER
        while place:
            if forward[place] - second[place] < loss:
                loss = forward[place] - second[place]
            length, known = last[place]
            place -= length
            ids.append(known[0])
        if loss > -_NEVER // 2:
            loss = -_NEVER
        return forward[n], [i for piece in reversed(ids) for i in piece], loss

    def _spell(self, word: str, start: int, end: int, forward: list[int], last: list) -> None:
        """Places at which no piece ends are reached by bytes only."""
        for place in range(start + 1, end + 1):
            known = self.spelled(word[place - 1])
            forward[place], last[place] = forward[place - 1] + known[1], (1, known)

    def paths(self, word: str, best: int) -> list[tuple[int, tuple[int, ...]]]:
        """The best paths of one word, best first; of equal scores the one found last goes first, so equals do not fan out."""
        arcs, forward = self.lattice(word)
        n = len(word)
        found, tick = [], 0
        # entries: loss so far (exact, as what is left costs what forward says), newest first, place, score behind, pieces behind
        heap = [(-forward[n], 0, n, 0, None)]
        while heap:
            total, _, place, behind, chain = heapq.heappop(heap)
            if place == 0:
                ids: list[int] = []
                while chain:
                    (piece, _), chain = chain
                    ids += piece
                found.append((-total, tuple(ids)))
                if len(found) == best:
                    break
                continue
            for start, piece in arcs[place]:
                tick -= 1
                score = piece[1] + behind
                heapq.heappush(heap, (-(forward[start] + score), tick, start, score, (piece, chain)))
        return found

    def decode(self, ids) -> str:
        """The text of a path: pieces and bytes, without the blank put before the text."""
        return self.raw(ids).removeprefix(b" ").decode("utf-8", "surrogatepass")

    def raw(self, ids) -> bytes:
        """What pieces stand for, in UTF-8."""
        return b"".join(map(self.text.__getitem__, ids))


class _Words(dict):
    """Words by number, with their best paths in flat arrays."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.totals, self.losses, self.starts, self.lengths, self.pool = array("q"), array("q"), array("q"), array("q"), array("i")

    def __missing__(self, word: str) -> int:
        total, ids, loss = self.vocabulary.best(word)
        self.totals.append(total)
        self.losses.append(loss)
        self.starts.append(len(self.pool))
        self.lengths.append(len(ids))
        self.pool.extend(ids)
        self[word] = number = len(self.totals) - 1
        return number


class Segmenter:
    """N-best paths of texts; remembers words up to a bound."""

    def __init__(self, vocabulary: Vocabulary, best: int = BEST) -> None:
        self.vocabulary, self.best = vocabulary, best
        self.words = _Words(vocabulary)
        self.further: dict[str, list] = {}

    def _paths(self, word: str) -> list:
        """The best paths of a word; short words whose paths are close come again and again."""
        known = self.further.get(word)
        if known is None:
            known = self.vocabulary.paths(word, self.best)
            if len(self.further) >= _CACHE // 8:
                self.further.clear()
            if len(word) <= 64:
                self.further[word] = known
        return known

    def segment(self, text: str | None) -> tuple[float, np.ndarray, list[tuple[float, list]]]:
        """Score and pieces of the best path; then each further path's score and edits ``(from, to, pieces)`` of the best."""
        if not text:
            return 0.0, np.empty(0, np.int32), []
        if len(self.words) > _CACHE or len(self.words.pool) > 16 * _CACHE:
            self.words = _Words(self.vocabulary)
        memory = self.words
        words = _WORD.findall(BLANK + text.replace(BLANK, _LITERAL).replace(" ", BLANK))
        number = np.fromiter(map(memory.__getitem__, words), np.int64, len(words))
        lengths = np.frombuffer(memory.lengths, np.int64)[number]
        starts = np.frombuffer(memory.starts, np.int64)[number]
        losses = np.frombuffer(memory.losses, np.int64)[number]
        total = int(np.frombuffer(memory.totals, np.int64)[number].sum())
        bases = np.cumsum(lengths) - lengths
        ids = np.frombuffer(memory.pool, np.int32)[np.arange(int(lengths.sum())) + np.repeat(starts - bases, lengths)]
        options = []
        for i in self._least(losses):
            first, *rest = self._paths(words[i])
            base = int(bases[i])
            options.append([(first[0] - score, base, base + int(lengths[i]), path) for score, path in rest])
        # best first over how far each chosen word is from its best path
        start = (0,) * len(options)
        heap, seen, out = [(0, start)], {start}, []
        while heap and len(out) < self.best:
            loss, steps = heapq.heappop(heap)
            taken = sorted(options[k][n - 1][1:] for k, n in enumerate(steps) if n)
            out.append(((total - loss) / UNIT, taken))
            for k, n in enumerate(steps):
                further = steps[:k] + (n + 1,) + steps[k + 1 :]
                if n < len(options[k]) and further not in seen:
                    seen.add(further)
                    heapq.heappush(heap, (sum(options[j][m - 1][0] for j, m in enumerate(further) if m), further))
        return total / UNIT, ids, out[1:]

    def _least(self, losses: np.ndarray) -> list[int]:
        """Places of the N - 1 words whose second path loses least, earlier places first among equals."""
        wanted = min(self.best - 1, len(losses))
        if not wanted:
            return []
        bound = np.partition(losses, wanted - 1)[wanted - 1]
        near = np.flatnonzero(losses <= min(bound, -_NEVER - 1))
        return near[np.argsort(losses[near], kind="stable")][:wanted].tolist()


def edited(ids, edits) -> list[int]:
    """A further path from the best one and its edits."""
    out = list(ids)
    for start, end, pieces in sorted(edits, reverse=True):
        out[start:end] = pieces
    return out


_EDITS = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))
_FIELDS = "score double, ids array<int>, others array<struct<score: double, edits: array<struct<start: int, end: int, ids: array<int>>>>>"


_READ_BACK = ", decoded_chars bigint, decoded_sha256 string, others_agree boolean"


def _read_back(vocabulary: Vocabulary, ids: np.ndarray, others: list[dict]) -> tuple[int, str, bool]:
    """Length and digest of the decoded best path, and whether all others decode alike.

    A path's text is its pieces' bytes in order, so another path agrees if each of its edits stands for what it replaces.
    """
    best = ids.tolist()
    raw = vocabulary.raw(best).removeprefix(b" ")
    same = all(vocabulary.raw(e["ids"]) == vocabulary.raw(best[e["start"] : e["end"]]) for path in others for e in path["edits"])
    return len(raw.decode("utf-8", "surrogatepass")), hashlib.sha256(raw).hexdigest(), same


def _encoded(batches: Iterator[pa.RecordBatch], model: bytes, best: int, read_back: bool) -> Iterator[pa.RecordBatch]:
    segmenter = Segmenter(Vocabulary(model), best)
    for batch in batches:
        start, scores, flat, ends, others, again = 0, [], [], [0], [], []
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            score, ids, rest = segmenter.segment(text.as_py())
            scores.append(score)
            flat.append(ids)
            ends.append(ends[-1] + len(ids))
            others.append([{"score": s, "edits": [{"start": a, "end": b, "ids": p} for a, b, p in edits]} for s, edits in rest])
            if read_back:
                again.append(_read_back(segmenter.vocabulary, ids, others[-1]))
            if ends[-1] > 1_000_000 or i + 1 == len(batch):
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
                found = [pa.array(scores, pa.float64()), ids, pa.array(others, _EDITS)]
                names = ["score", "ids", "others"]
                if read_back:
                    found += [pa.array(x, t) for x, t in zip(zip(*again, strict=True), (pa.int64(), pa.string(), pa.bool_()), strict=True)]
                    names += ["decoded_chars", "decoded_sha256", "others_agree"]
                kept = batch.slice(start, i + 1 - start).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, *found], [*batch.schema.names[:-1], *names])
                start, scores, flat, ends, others, again = i + 1, [], [], [0], [], []


def encode(df: DataFrame, model: bytes, text: str = "text", best: int = BEST, read_back: bool = False) -> DataFrame:
    """All columns but the text, and ``score``, ``ids``, ``others``: the best path, and up to ``best - 1`` further ones as edits of it.

    With ``read_back`` the paths are decoded in the same task: ``decoded_chars`` and ``decoded_sha256`` (UTF-8) of the text that the
    best path gives, and ``others_agree``, whether all further ones give the same. Columns of these names are replaced.
    """
    added = ("score", "ids", "others", *(("decoded_chars", "decoded_sha256", "others_agree") if read_back else ()))
    columns = [c for c in df.columns if c not in (text, *added)]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), _FIELDS + (_READ_BACK if read_back else "")])
    rows = df.select(*columns, F.col(text).cast("string"))
    return rows.mapInArrow(partial(_encoded, model=model, best=best, read_back=read_back), schema)


def _decoded(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary(model)
    for batch in batches:
        texts = [vocabulary.decode(ids.as_py() or []) for ids in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "text"])


def decode(df: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """All other columns and ``text``, from a column of piece ids."""
    columns = [c for c in df.columns if c not in (ids, "text")]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), "text string"])
    return df.select(*columns, ids).mapInArrow(partial(_decoded, model=model), schema)
