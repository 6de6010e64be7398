"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

Merging repeatedly joins the adjacent pair whose union has the best score, leftmost first. Its result is the only
sequence of pieces in which every two neighbours stay apart when their union is merged again. So a text is encoded
from the left: at each position the longest piece that matches there (Aho-Corasick automaton over all pieces) is
tried first; if it would merge differently with the piece before it, the next shorter one that begins it is tried;
if none is left, the position is marked as failed in a bit field and the piece before it is taken back. Whether two
pieces stay apart is found by undoing the merges along their seam, latest first, and is remembered. Where all
longest matches stay apart, as in most words, one run of the automaton gives the answer.

No piece holds a character followed by a space mark, so texts fall apart before each space and the result of a word is
cached in its worker. Characters without a piece become their UTF-8 bytes' pieces. Decoding is the library's.

Defined results: a NULL or empty text has no ids and decodes to the empty text. Very long texts and words are read
whole. Rows that repeat are encoded one by one. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from tillhouse.llm.common import map_rows

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Entries of a worker's caches: words with their ids, and neighbours with their verdict.
WORDS, CACHED_LENGTH = 400_000, 64
SEAMS = 2_000_000


class Encoder:
    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.bytes_ = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = {}
        for i in range(size):
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i)):
                plain[self.library.id_to_piece(i)] = i
        # the order in which merges happen: better scores first; equal scores happen in the order of the text,
        # and only the whitespace runs of a model share one
        self.score = {piece: self.library.get_score(i) for piece, i in plain.items()}
        self.ids = plain
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(plain, key=len):
            if self._reachable(piece):
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.seams: dict[tuple[str, str], bool] = {}
        self.numbers = {piece: b"%d" % number for piece, number in plain.items()}
        self.words: dict[str, bytes] = {}  # ids of a space mark and what follows it
        self.older: dict[str, bytes] = {}  # the cache before, still looked into
        self.marks: dict[str, bytes] = {}
        self.joined = {piece[i : i + 2] for piece in plain for i in range(len(piece) - 1)}
        self.longest = max(map(len, plain), default=1)
        self.characters = {piece for piece in plain if len(piece) == 1}
        runs = any(SPACE in piece.lstrip(SPACE) for piece in plain)
        assert not runs, "a piece holds a space mark after another character"
        self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        assert not any("\n" in piece for piece in plain), "a piece holds a line end"

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by plain merging."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _reachable(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece; notes the last merge."""
        if len(piece) == 1:
            self.halves[piece] = None
            return True
        parts = list(piece)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return False
            if len(parts) == 2:
                self.halves[piece] = (parts[0], parts[1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the text of two neighbouring pieces gives these two pieces again."""
        key = (left, right)
        known = self.seams.get(key)
        if known is None:
            if len(self.seams) >= SEAMS:
                self.seams.clear()
            known = self.seams[key] = self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        """Undo the merges along the seam, the latest first, until a pair across it would have been merged earlier.

        ends: score of the merge that ended the pair of pieces now at the seam. The pair must not have merged
        before that; with equal scores the merge further left comes first.
        """
        ends, ended_left = float("-inf"), True
        while True:
            across = self.score.get(left + right)
            if across is not None and (across > ends or across == ends and not ended_left):
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            # of two equal scores the left one merged first, so the right one is undone first
            if b is None or a is not None and self.score[left] < self.score[right]:
                ends, ended_left, left = self.score[left], True, a[1]
            else:
                ends, ended_left, right = self.score[right], False, b[0]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without the cache; a character that no piece holds is a piece of its own."""
        if self.characters.issuperset(text):
            return self._run(text)
        out: list[str] = []
        start = 0
        for i, char in enumerate(text):
            if char not in self.characters:
                out += self._run(text[start:i])
                out.append(char)
                start = i + 1
        return out + self._run(text[start:])

    def _run(self, text: str) -> list[str]:
        """Backtracking over a text all of whose characters are pieces."""
        n = len(text)
        if not n:
            return []
        out = [piece for _, piece in self.automaton.iter_long(text)]
        seams = self.seams
        for i, key in enumerate(zip(out, out[1:], strict=False)):
            apart = seams.get(key)
            if apart is None:
                apart = self.apart(*key)
            if not apart:
                break
        else:
            return out
        # from the first seam that does not hold
        del out[i + 1 :]
        at = sum(map(len, out))
        failed = bytearray(n // 8 + 1)
        ids, longest_prefix, most = self.ids, self.automaton.longest_prefix, self.longest
        size = len(key[1]) - 1
        last = out[-1]
        while at < n:
            while size > 0:
                end = at + size
                piece = text[at:end]
                if piece in ids and not failed[end >> 3] >> (end & 7) & 1:
                    apart = seams.get((last, piece)) if last else True
                    if apart is None:
                        apart = self.apart(last, piece)
                    if apart:
                        break
                size -= 1
            if size > 0:
                out.append(piece)
                last, at = piece, end
                size = longest_prefix(text[at : at + most])
            else:
                failed[at >> 3] |= 1 << (at & 7)
                size = len(out.pop()) - 1
                at -= size + 1
                last = out[-1] if out else ""
        return out

    def _made(self, chunk: str) -> bytes:
        """Ids of a text without spaces after other characters, as decimal numbers joined by commas."""
        if self.characters.issuperset(chunk):
            return b",".join([self.numbers[piece] for piece in self._run(chunk)])
        numbers = self.numbers
        out = []
        for part in self.cut.findall(chunk):
            for piece in self.pieces(part):
                number = numbers.get(piece)
                out.append(number if number is not None else b",".join([b"%d" % self.bytes_[b] for b in piece.encode()]))
        return b",".join(out)

    def _entry(self, chunk: str) -> bytes:
        """The same of a space mark and a text without spaces, through the cache.

        A last character that no piece holds after the one before it is encoded apart, so that a word and the
        same word before a full stop share their entry.
        """
        entry = self.words.get(chunk) or self.older.get(chunk)
        if entry is None:
            if len(chunk) > 1 and not chunk[-1].isalnum() and chunk[-2:] not in self.joined:
                entry = self._entry(chunk[:-1]) + b"," + self._mark(chunk[-1])
            else:
                entry = self._made(SPACE + chunk)
        if len(chunk) <= CACHED_LENGTH:
            if len(self.words) >= WORDS:
                self.words, self.older = {}, self.words
            self.words[chunk] = entry
        return entry

    def _mark(self, mark: str) -> bytes:
        entry = self.marks.get(mark)
        if entry is None:
            entry = self.marks[mark] = self._made(mark)
        return entry

    def joined_ids(self, text: str) -> bytes:
        """The ids of a whole text as decimal numbers joined by commas."""
        if not text:
            return b""
        if SPACE in text or "  " in text or text[0] == " ":
            # runs of space marks are merged with each other
            return b",".join([self._made(chunk) for chunk in self.cut.findall(SPACE + text.replace(" ", SPACE))])
        chunks = text.split(" ")
        entries = list(map(self.words.get, chunks))
        if None in entries:
            entries = [entry or self._entry(chunk) for chunk, entry in zip(chunks, entries, strict=True)]
        return b",".join(entries)

    def encode(self, text: str) -> list[int]:
        return np.fromstring(self.joined_ids(text), dtype=np.int64, sep=",").tolist() if text else []


@cache
def encoder(name_or_path: str) -> Encoder:
    """One per worker; a bare name is looked up among the public tokenizers."""
    return Encoder(name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path))


def encode_and_decode(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; one pass, no shuffle."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        known = encoder(model)
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in batch["text"]:
                joined = known.joined_ids(text or "")
                ids = np.fromstring(joined, dtype=np.int64, sep=",").tolist() if joined else []
                decoded = known.library.decode(ids) if ids else ""
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(joined).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            yield out

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
