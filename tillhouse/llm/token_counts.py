"""Token counts of whole texts by a two-tier lookup of pre-tokens.

A first pass finds the frequent pre-tokens of all texts: each task keeps a bounded summary of counts, and summaries
are merged in a tree. Their token counts are broadcast as one compact table of at most FREQUENT entries, each at
most LONGEST characters long. The second pass adds up the counts: what the table lacks is encoded by the library
through a cache in the worker. No pre-token is shuffled, and the table decides only what is looked up where, never
the result.

Defined results: a NULL text counts as empty (0 bytes, 0 tokens). Special strings inside texts are single tokens,
as the library has it by default. Texts with characters outside the pattern's range go to the library whole. Texts of any
length are counted whole. Repeated rows are counted one by one. Pre-tokens that are equally frequent compete for the last places
of the table, which changes no count. An empty table gives no rows. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

from pyspark.sql import DataFrame

from tillhouse.llm.bytepair import encoder
from tillhouse.llm.common import gathered, map_rows

TOKENIZER = "byte_bpe_50k.json"
FREQUENT = 1 << 15
LONGEST = 48
OVER = 512
#: Entries of a task's summary while it counts, and of what it hands on.
WORKING = 1 << 17
HANDED_ON = 1 << 14


def _trimmed(counts: Counter, n: int) -> Counter:
    return Counter(dict(counts.most_common(n)))


def frequent(texts: DataFrame, tokenizer: str = TOKENIZER, n: int = FREQUENT) -> list[str]:
    """The pre-tokens with the largest counts over all texts (those of a task's rarest may be missed)."""

    def handed(counts: Counter) -> Iterator[dict[str, list]]:
        top = sorted(counts.most_common(HANDED_ON))
        yield {"words": [[word for word, _ in top]], "counts": [[count for _, count in top]]}

    def count(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        tokenizer_, counts = encoder(tokenizer), Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(tokenizer_.pretokens(text or "") or ())
                if len(counts) > 2 * WORKING:
                    counts = _trimmed(counts, WORKING)
        yield from handed(Counter({word: c for word, c in counts.items() if len(word) <= LONGEST}))

    def merge(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        counts: Counter = Counter()
        for batch in batches:
            for words, numbers in zip(batch["words"], batch["counts"], strict=True):
                for word, number in zip(words, numbers, strict=True):
                    counts[word] += number
        yield from handed(counts)

    schema = "words array<string>, counts array<long>"
    total: Counter = Counter()
    for row in gathered(map_rows(texts.select("text"), count, schema), merge, schema):
        for word, number in zip(row.words, row.counts, strict=True):
            total[word] += number
    return [word for word, _ in sorted(total.items(), key=lambda item: (-item[1], item[0]))[:n]]


class Table:
    """Pre-tokens and their token counts, packed for the broadcast; workers unpack it once."""

    def __init__(self, words: list[str], lengths: list[int]):
        self.words = "\0".join(words)
        self.lengths = bytes(min(255, n) for n in lengths)

    @cache  # noqa: B019 - one table lives as long as its worker needs it
    def unpacked(self) -> dict[str, int]:
        return dict(zip(self.words.split("\0"), self.lengths, strict=True)) if self.lengths else {}


def length_table(words: list[str], tokenizer: str = TOKENIZER) -> Table:
    known = encoder(tokenizer)
    # what the packing cannot hold is left to the second tier
    pairs = [(word, known.length(word)) for word in words if "\0" not in word]
    pairs = [(word, n) for word, n in pairs if n < 256]
    return Table([word for word, _ in pairs], [n for _, n in pairs])


def n_tokens(text: str, lengths: dict[str, int], known) -> int:
    """Tokens of one text; lengths: the worker's dictionary, which holds both tiers."""
    total = 0
    for i, part in enumerate(known.segments(text)):
        if i % 2:
            total += 1
            continue
        found = known.pretokens(part)
        if found is None:
            total += len(known.whole(part))
            continue
        try:
            total += sum([lengths[word] for word in found])
        except KeyError:
            new = {word: known.length(word) for word in {word: None for word in found if word not in lengths}}
            total += sum([new[word] if word in new else lengths[word] for word in found])
            lengths.update((word, n) for word, n in new.items() if len(word) <= 64)
    return total


def count_tokens(documents: DataFrame, tokenizer: str = TOKENIZER, over: int = OVER, cache_entries: int = 250_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; no shuffle of text or pre-tokens."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(length_table(frequent(documents, tokenizer), tokenizer))

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        first = shared.value.unpacked()
        lengths, known = dict(first), encoder(tokenizer)
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            numbers = []
            for text in texts:
                numbers.append(n_tokens(text, lengths, known))
                if len(lengths) > cache_entries + len(first):
                    lengths = dict(first)
            yield {
                "doc_id": batch["doc_id"],
                "n_bytes": [len(text.encode()) for text in texts],
                "n_tokens": numbers,
                "over_limit": [n > over for n in numbers],
            }

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
