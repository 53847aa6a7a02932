"""Token counts by byte-pair merging, without producing token ids.

A count never needs ids: it is the number of initial symbols of a word minus the
merges that apply to it. Merges are found with a heap of adjacent pairs, lowest
rank first, over a doubly linked list of symbols. Words repeat, so each worker
keeps the counts of chunks it has seen in a bounded table; texts are cut at white
space only, which no rule of the vocabulary crosses.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from runlens.llm.shared import pick, text_batches, texts_of

# Most chunks and words whose counts a worker keeps; a table starts anew beyond it.
KEPT_CHUNKS, KEPT_WORDS = 400_000, 800_000

# A symbol that no pair holds, and the bits of a heap entry that name a place.
_GONE, _PLACE = (1 << 32) - 1, (1 << 40) - 1

# Separators that Python's split() drops and the vocabulary counts as symbols.
_CONTROLS = "\x1c\x1d\x1e\x1f"
_WHITE = re.compile(r"[\t-\r \x85\xa0  -     　]+")


def chunks_of(text: str) -> list[str]:
    """The text cut at Unicode white space."""
    if any(c in text for c in _CONTROLS):
        return [x for x in _WHITE.split(text) if x]
    return text.split()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of chunks under a byte-level merge list with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        number: dict[str, int] = {}
        of = lambda symbol: number.setdefault(symbol, len(number))
        # By pair of symbols: its rank, moved left of any place in a word, and what it becomes.
        self.pairs = {
            of(a) << 32 | of(b): (rank << 40, of(a + b)) for rank, (a, b) in enumerate(model["merges"])
        }
        self.first = [of(x) for x in byte_symbols()]
        self.last = [of(x + end) for x in byte_symbols()]
        specials = [x["content"] for x in spec["added_tokens"]]
        self.specials = set(specials)
        self.cut = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        """Initial symbols minus merges."""
        raw = word.encode("utf-8")
        symbols = [self.first[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        n, pairs = len(symbols), self.pairs
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = pairs.get(symbols[i] << 32 | symbols[i + 1])
            if found is not None:
                heap.append(found[0] | i)
        heapq.heapify(heap)
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            i = top & _PLACE
            j = after[i]
            if j >= n:
                continue
            found = pairs.get(symbols[i] << 32 | symbols[j])
            if found is None or found[0] != top - i:
                continue  # one of the two has been merged meanwhile
            merges += 1
            merged = symbols[i] = found[1]
            symbols[j] = _GONE
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = pairs.get(merged << 32 | symbols[k])
                if found is not None:
                    heapq.heappush(heap, found[0] | i)
            h = before[i]
            if h >= 0:
                found = pairs.get(symbols[h] << 32 | merged)
                if found is not None:
                    heapq.heappush(heap, found[0] | h)
        return n - merges

    def count_known(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.words[word] = self.count_word(word)
        return n

    def count_chunk(self, chunk: str) -> int:
        if chunk.isascii():  # mostly letters, and one mark after them
            if chunk.isalpha():
                return self.count_known(chunk.lower())
            if chunk[-1] in ".," and chunk[:-1].isalpha():
                return self.count_known(chunk[:-1].lower()) + self.count_known(chunk[-1])
        parts = self.cut.split(chunk) if self.cut and "<" in chunk else [chunk]
        total = 0
        for part in parts:
            if part in self.specials:
                total += 1
                continue
            plain = unicodedata.normalize("NFC", part)
            # lower() writes a final sigma by its place in the word; the vocabulary does not.
            for word in self.word.findall(plain.replace("Σ", "σ").lower()):
                total += self.count_known(word)
        return total

    def count(self, text: str) -> int:
        known = self.chunks
        if len(known) > KEPT_CHUNKS:
            known.clear()
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        parts = chunks_of(text)
        try:
            return sum(map(known.__getitem__, parts))
        except KeyError:
            for part in parts:
                if part not in known:
                    known[part] = self.count_chunk(part)
            return sum(map(known.__getitem__, parts))


@functools.cache
def counter(path: str) -> MergeCounter:
    """One counter per worker process and vocabulary file."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Bytes and tokens of every text: doc_id, n_bytes, n_tokens, over_limit.

    One row per input row, in one pass without a shuffle. NULL counts as the empty
    text (0 bytes, 0 tokens); a NULL doc_id is kept, repeated rows are counted each,
    an empty table gives an empty one, and extra columns are ignored.
    """
    text_batches(docs.sparkSession)

    def run(batches):
        count = counter(vocabulary).count
        for batch in batches:
            texts = texts_of(batch)
            tokens = [count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x.encode("utf-8")) for x in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)
