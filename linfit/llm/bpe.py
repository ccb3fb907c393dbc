"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every prefix of a piece ends in one token: the only one that ends there, fits the
last token of the prefix before it, and so keeps the whole sequence a result of the merges. An
encoder stores that token for each prefix. Appending bytes goes on from the stored prefixes;
after an edit, encoding restarts at the edit and stops as soon as stored states are met again.

Whether two tokens fit follows from the ranks alone: merging the bytes on both sides of their
border must never join across it before the two tokens themselves are complete.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Callable, Iterable
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame

from linfit.llm.common import map_rows

#: Pieces that a task remembers: the first ones it meets, so the common ones. Any others are
#: encoded once for each slice of rows.
REMEMBERED = 200_000
#: Characters of texts that are cut into pieces at one time, and pieces of a longer text.
TOGETHER = 4_000_000
PIECES = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class BytePairs:
    """Ranks, the tokens' own splits, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.texts = [str(i) for i in range(max(self.tokens, default=-1) + 1)]
        # A trie of the tokens: ``steps`` leads from a node and a byte to the next node, nodes
        # being multiples of 256; ``at_node`` has the token that ends there, or -1.
        self.steps: dict[int, int] = {}
        self.at_node = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                after = self.steps.get(node + byte)
                if after is None:
                    after = self.steps[node + byte] = len(self.at_node) << 8
                    self.at_node.append(-1)
                node = after
            self.at_node[node >> 8] = rank
        self.fits: dict[int, bool] = {}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self._link()

    def _link(self) -> None:
        """From each node: the node of its longest proper ending, and the longest token it ends in.

        ``shorter`` leads from a token to the next shorter one that it ends in.
        """
        below: list[list[tuple[int, int]]] = [[] for _ in self.at_node]
        for key, after in self.steps.items():
            below[key >> 8].append((key & 255, after))
        self.ending = [0] * len(self.at_node)
        self.longest_at = list(self.at_node)
        self.shorter: dict[int, int] = {}
        level = [0]
        while level:
            deeper = []
            for node in level:
                for byte, after in below[node >> 8]:
                    back = self.ending[node >> 8]
                    while node and (to := self.steps.get(back + byte)) is None and back:
                        back = self.ending[back >> 8]
                    to = (to or 0) if node else 0
                    self.ending[after >> 8] = to
                    token = self.at_node[after >> 8]
                    if token < 0:
                        self.longest_at[after >> 8] = self.longest_at[to >> 8]
                    else:
                        self.shorter[token] = self.longest_at[to >> 8]
                    deeper.append(after)
            level = deeper
        self.sizes = {rank: len(token) for rank, token in self.tokens.items()}
        self.moves: dict[int, int] = {}

    def move(self, node: int, byte: int) -> int:
        """The node of the longest ending of ``node``'s bytes and ``byte`` that begins a token."""
        at = node
        while (to := self.steps.get(at + byte)) is None and at:
            at = self.ending[at >> 8]
        if len(self.moves) > 2 * REMEMBERED:
            self.moves.clear()
        self.moves[node + byte] = to = to or 0
        return to

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a single byte.

        The last merge of a token joins two tokens that fit; exactly one split does, as the
        encoding of the bytes before that merge is unique.
        """
        if token not in self.splits:
            data, found = self.tokens[token], None
            if len(data) > 1:
                # Merge its bytes by rank until two parts are left.
                parts = [data[i : i + 1] for i in range(len(data))]
                while len(parts) > 2:
                    ranked = [
                        (r, i)
                        for i in range(len(parts) - 1)
                        if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None and r < token
                    ]
                    if not ranked:
                        break
                    i = min(ranked)[1]
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if len(parts) == 2:
                    found = self.ranks[parts[0]], self.ranks[parts[1]]
            self.splits[token] = found
        return self.splits[token]

    def fit(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when their joined bytes are encoded."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 2 * REMEMBERED:
                self.fits.clear()
            known = self.fits[key] = self._fit(left, right)
        return known

    def _fit(self, a: int, b: int) -> bool:
        # ``limit``: the rank of the merge that undid last; joins above it come too late.
        limit = 1 << 62
        tokens, ranks = self.tokens, self.ranks
        while True:
            joined = ranks.get(tokens[a] + tokens[b])
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit = a
                parts = self.split(a)
                if parts is None:
                    return True
                a = parts[1]
                if a == limit:
                    return True
            else:
                limit = b + 1
                parts = self.split(b)
                if parts is None:
                    return True
                b = parts[0]

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The token that the encoding of ``data[:end]`` ends in; ``last`` has the shorter ones'."""
        ranks, tokens = self.ranks, self.tokens
        for start in range(max(0, end - self.longest), end):
            token = ranks.get(data[start:end])
            if token is None:
                continue
            if start == 0:
                if self.whole(token):
                    return token
                continue
            if self.fit(last[start], token):
                return token
        raise ValueError(f"no token ends at byte {end}")

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        return len(self.tokens[token]) == 1 or self.split(token) is not None

    def prefixes(self, data: bytes) -> list[int]:
        """Last token of each prefix; place 0 is unused.

        Tokens are tried by where they start, which finds the same ones as ``last_token``.
        """
        n = len(data)
        last = [-1] * (n + 1)
        step, at_node, fits, fit = self.steps.get, self.at_node, self.fits.get, self.fit
        for start in range(n):
            left = last[start]
            node, end = 0, start
            while end < n:
                node = step(node + data[end])
                if node is None:
                    break
                end += 1
                if last[end] >= 0:
                    continue
                token = at_node[node >> 8]
                if token < 0:
                    continue
                if start:
                    known = fits(left << 32 | token)
                    if known is None:
                        known = fit(left, token)
                    if not known:
                        continue
                elif not self.whole(token):
                    continue
                last[end] = token
        return last

    def read_back(self, last: list[int]) -> list[int]:
        out, end = [], len(last) - 1
        while end:
            token = last[end]
            out.append(token)
            end -= len(self.tokens[token])
        out.reverse()
        return out

    def encode(self, data: bytes) -> list[int]:
        token = self.ranks.get(data)
        if token is not None and self.whole(token):
            return [token]
        return self.read_back(self.prefixes(data))


class Prefixes:
    """The encoding of a piece that grows and changes."""

    def __init__(self, pairs: BytePairs, data: bytes = b""):
        self.pairs, self.data = pairs, b""
        self.last = [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Encode ``more`` after what is there; nothing before it is looked at again."""
        start = len(self.data)
        self.data += more
        for end in range(start + 1, len(self.data) + 1):
            self.last.append(self.pairs.last_token(self.data, end, self.last))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; the number of prefixes encoded again.

        Behind the edit, once as many prefixes in a row as the longest token has bytes are as
        they were, so are all that follow.
        """
        tail = self.last[stop + 1 :]
        self.data = self.data[:start] + new + self.data[stop:]
        del self.last[start + 1 :]
        same, edge = 0, start + len(new)
        for end in range(start + 1, len(self.data) + 1):
            token = self.pairs.last_token(self.data, end, self.last)
            self.last.append(token)
            if end > edge:
                same = same + 1 if tail[end - edge - 1] == token else 0
                if same >= self.pairs.longest:
                    self.last += tail[end - edge :]
                    return end - start
        return len(self.data) - start

    @property
    def ids(self) -> list[int]:
        return self.pairs.read_back(self.last)


class SortedPrefixes:
    """Encodings of byte strings given in order; each goes on from the prefix it shares with the last.

    Beside the last token of each prefix it keeps the node of the trie that the prefix ends in,
    from which the tokens that end there are known.
    """

    def __init__(self, pairs: BytePairs):
        self.pairs, self.data = pairs, b""
        self.last: list[int] = [-1]
        self.nodes: list[int] = [0]

    def encode(self, data: bytes) -> list[int]:
        pairs, last, nodes = self.pairs, self.last, self.nodes
        move, fits, longest, sizes = pairs.moves.get, pairs.fits.get, pairs.longest_at, pairs.sizes
        same = 0
        for x, y in zip(self.data, data, strict=False):
            if x != y:
                break
            same += 1
        del last[same + 1 :], nodes[same + 1 :]
        node = nodes[same]
        for end in range(same + 1, len(data) + 1):
            byte = data[end - 1]
            to = move(node + byte)
            node = pairs.move(node, byte) if to is None else to
            nodes.append(node)
            token = longest[node >> 8]
            while token >= 0:
                start = end - sizes[token]
                if start:
                    known = fits(last[start] << 32 | token)
                    if known is None:
                        known = pairs.fit(last[start], token)
                else:
                    known = pairs.whole(token)
                if known:
                    break
                token = pairs.shorter[token]
            if token < 0:
                raise ValueError(f"no token ends at byte {end}")
            last.append(token)
        self.data = data
        return pairs.read_back(last)


class TextCodec:
    """Texts to ids and back: every match of a pattern, a piece, is encoded by itself."""

    def __init__(self, pairs: BytePairs, pattern: str):
        self.pairs = pairs
        self.pattern = regex.compile(pattern)
        #: Of each piece its ids as decimals, and the bytes that they decode to.
        self.decimals: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> list[str]:
        """Encode the pieces that are not known; returns those that are to be forgotten again."""
        new = {p.encode("utf-8", "replace"): p for p in pieces if p not in self.decimals}
        room = max(0, REMEMBERED - len(self.decimals))
        prefixes, texts = SortedPrefixes(self.pairs), self.pairs.texts
        for data in sorted(new):
            ids, piece = prefixes.encode(data), new[data]
            self.decimals[piece] = ",".join([texts[i] for i in ids])
            self.decoded[piece] = self.decode(ids)
        return list(new.values())[room:]

    def coded(self, texts: list[str | None]) -> list[tuple[str, bytes]]:
        """Ids as decimals with commas between them, and the bytes they decode to."""
        out = []
        while texts:
            size, n = 0, 0
            while n < len(texts) and (not n or size + len(texts[n] or "") <= TOGETHER):
                size += len(texts[n] or "")
                n += 1
            if size > TOGETHER:
                out.append(self._coded_long(texts[0]))
            else:
                out += self._coded([self.pattern.findall(t or "") for t in texts[:n]])
            texts = texts[n:]
        return out

    def _coded(self, found: list[list[str]]) -> list[tuple[str, bytes]]:
        # Millions of pieces and no cycles among them: the collector would only walk over them.
        collects = gc.isenabled()
        gc.disable()
        try:
            over = self.learn(set().union(*found))
            ids, data = self.decimals.__getitem__, self.decoded.__getitem__
            out = [(",".join(map(ids, pieces)), b"".join(map(data, pieces))) for pieces in found]
            for p in over:
                del self.decimals[p], self.decoded[p]
        finally:
            if collects:
                gc.enable()
        return out

    def _coded_long(self, text: str) -> tuple[str, bytes]:
        """One text, some of its pieces at a time."""
        matches, parts = (m.group() for m in self.pattern.finditer(text)), []
        while some := list(islice(matches, PIECES)):
            parts += self._coded([some])
        return ",".join(ids for ids, _ in parts), b"".join(data for _, data in parts)

    def encode(self, text: str | None) -> list[int]:
        """Ids of the whole text; null counts as empty."""
        return ids_of(self.coded([text])[0][0]).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pairs.tokens.__getitem__, ids))


def ids_of(decimals: str) -> np.ndarray:
    return np.fromstring(decimals, np.int32, sep=",")


def _codec_rows(docs: DataFrame, path: str, pattern: str, work, schema: str, carry) -> DataFrame:
    # The automaton of a fixed vocabulary.
    pairs = docs.sparkSession.sparkContext.broadcast(BytePairs(read_ranks(path)))

    def start() -> Callable:
        codec = TextCodec(pairs.value, pattern)
        return lambda batch: work(codec, batch)

    return map_rows(docs, start, schema, carry)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids array<int>``, the tokens of the whole text (null counts as empty)."""

    def work(codec: TextCodec, batch) -> dict:
        return {"ids": [ids_of(d) for d, _ in codec.coded(batch.column("text").to_pylist())]}

    return _codec_rows(docs, path, pattern, work, "ids array<int>", tuple(docs.columns))


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``coded`` with ``decoded binary``, the bytes of ``ids``."""

    def work(codec: TextCodec, batch) -> dict:
        return {"decoded": [codec.decode(i or []) for i in batch.column("ids").to_pylist()]}

    return _codec_rows(coded, path, pattern, work, "decoded binary", tuple(coded.columns))


def _digested(codec: TextCodec, batch) -> dict:
    """Tokens of each whole text, decoded again; digests of both."""
    coded = codec.coded(batch.column("text").to_pylist())
    return {
        "n_tokens": [ids.count(",") + bool(ids) for ids, _ in coded],
        "ids_sha256": [hashlib.sha256(ids.encode()).hexdigest() for ids, _ in coded],
        "decoded_sha256": [hashlib.sha256(data).hexdigest() for _, data in coded],
        "ids": [ids for ids, _ in coded],
    }


def _tokenised(codec: TextCodec, batch) -> dict:
    out = _digested(codec, batch)
    return out | {"ids": [ids_of(d) for d in out["ids"]]}


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document's whole text.

    Null texts count as empty: no tokens, the digests of nothing. Ids are digested as decimals
    with commas between them. One row per document, repeated rows included; an empty table gives
    an empty table. Texts of any length are encoded whole, very long ones some pieces at a time.
    """
    rows = docs.select("doc_id", "text")
    return _codec_rows(rows, path, pattern, _digested, DIGESTS, ("doc_id",))


def token_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, source and the tokens themselves, with the columns of ``token_digests``."""
    rows = docs.select("doc_id", "source", "text")
    schema = f"ids array<int>, {DIGESTS}"
    return _codec_rows(rows, path, pattern, _tokenised, schema, ("doc_id", "source"))
