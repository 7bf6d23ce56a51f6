"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

Where a merge table is applied lowest rank first, a sequence of tokens is the encoding of its bytes exactly when each
neighbouring pair of tokens is stable, i.e. no merge crosses the boundary before either side is consumed. So encoding
is a finite-state matter: a nondeterministic transducer reads a byte, walks the token trie from every boundary that is
still open, and ends a token where the pair with the token before that boundary is stable. For each prefix exactly one
such token exists. The set of open walks depends on the bytes alone: it is one state of the determinised machine (all
suffixes of the longest open walk), built with its transitions and its list of ending tokens when first needed.
A boundary closes once the longest open walk starts after it, so tokens that all open boundaries share are emitted
after a lookahead of at most the longest token.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import gathered, holding, lists, mapped, release

#: What a worker keeps before it starts anew: stable pairs, transitions, rows of states, pieces, units; no slice of
#: texts leaves pieces or units of more than UNIT_CHARS behind.
PAIRS, MOVES, ROWS, PIECES, UNITS, UNIT_CHARS = 1 << 18, 1 << 18, 1 << 13, 1 << 15, 1 << 16, 64
#: Bytes of text taken at once, pieces encoded at once, the longest piece among these, and bits of the table of pairs.
SLICE, BLOCK, TOGETHER, KNOWN_BITS = 1 << 20, 1 << 15, 64, 19
FREE, ODD, LATE = np.uint64((1 << 64) - 1), np.uint64(0x9E3779B97F4A7C15), (1 << 31) - 1
#: Bytes of a long piece between two emissions.
EMIT = 4096
NEVER = 1 << 62
#: The pattern for which single spaces separate independent units.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Transducer:
    """encode() bytes of one piece; tokens are emitted after bounded lookahead."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.token = ranks, {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.child: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        self.above = [(0, 0)]
        self.split: dict[int, tuple[int, int] | None] = {}
        self.stable: dict[int, bool] = {}
        for b, r in ranks.items():
            at = 0
            for c in b:
                to = self.child.get(at << 8 | c)
                if to is None:
                    to = self.child[at << 8 | c] = len(self.above)
                    self.above.append((at, c))
                at = to
            self.ends[at] = r
        self.shorter = {0: 0}
        self.moves: dict[int, int] = {}
        self.ending: dict[int, tuple[tuple[int, int], ...]] = {0: ()}

    def _suffix(self, state: int) -> int:
        """The state of the longest open walk but one."""
        to = self.shorter.get(state)
        if to is None:
            at, c = self.above[state]
            to = self.shorter[state] = self._move(self._suffix(at), c) if at else 0
        return to

    def _move(self, state: int, byte: int) -> int:
        to = self.moves.get(state << 8 | byte)
        if to is None:
            to = self.child.get(state << 8 | byte)
            if to is None:
                to = self._move(self._suffix(state), byte) if state else 0
            if len(self.moves) >= MOVES:
                self.moves.clear()
            self.moves[state << 8 | byte] = to
            self._ending(to)
        return to

    def _ending(self, state: int) -> tuple[tuple[int, int], ...]:
        """Tokens that end in a state, with their lengths, longest first."""
        out = self.ending.get(state)
        if out is None:
            own = self.ends.get(state)
            out = self._ending(self._suffix(state))
            if own is not None and self._made(own):
                out = ((own, len(self.token[own])), *out)
            self.ending[state] = out
        return out

    def _depth(self, state: int) -> int:
        n = 0
        while state:
            state, n = self.above[state][0], n + 1
        return n

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for a token that no merges make."""
        if token not in self.split:
            parts = [bytes([c]) for c in self.token[token]]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= token:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.split[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.split[token]

    def _made(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self._parts(token) is not None

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that touch one side of this token while it is built, latest first, each with the rank that consumes it."""
        out, end = [], NEVER
        while True:
            out.append((token, end))
            if len(self.token[token]) == 1:
                return out
            end, token = token, self._parts(token)[side]

    def _pair(self, a: int, b: int) -> bool:
        """Whether no merge crosses from a to b. Of equal ranks, the leftmost merge comes first."""
        if a < 0:  # -1 stands before the piece, -2 outside it
            self.stable[a << 32 | b] = a == -1
            return a == -1
        left, right, got = self._edge(a, 1), self._edge(b, 0), True
        while got:
            (x, x_end), (y, y_end) = left[-1], right[-1]
            rank = self.ranks.get(self.token[x] + self.token[y], NEVER)
            got = not (rank < x_end and rank <= y_end and rank < NEVER)
            if x_end == y_end == NEVER:
                break
            (left if x_end <= y_end else right).pop()
        if len(self.stable) >= PAIRS:
            self.stable.clear()
        self.stable[a << 32 | b] = got
        return got

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        moves, ending, stable, out = self.moves, self.ending, self.stable, []
        state, last = 0, [-2] * self.longest + [-1]
        at = pad = self.longest
        for byte in piece:
            to = moves.get(state << 8 | byte)
            state = self._move(state, byte) if to is None else to
            at += 1
            for token, n in ending[state]:
                good = stable.get(last[at - n] << 32 | token)
                if good is None:
                    good = self._pair(last[at - n], token)
                if good:
                    last.append(token)
                    break
            if at >= EMIT and at % 64 == 0:
                last[pad:] = self._emit(last[pad:], self._depth(state), out)
                at = len(last) - 1
        last = last[pad:]
        out += self._back(last, len(last) - 1)
        return out

    def _back(self, last: list[int], at: int) -> list[int]:
        """Tokens on the way to a boundary. The first entry is the token before the bytes in hand, or -1."""
        path = []
        while at > 0:
            path.append(last[at])
            at -= len(self.token[last[at]])
        return path[::-1]

    def _emit(self, last: list[int], depth: int, out: list[int]) -> list[int]:
        """Emits what all open boundaries share, and returns what is still in hand."""
        shared = None
        for at in range(len(last) - 1 - depth, len(last)):
            way = set()
            while at > 0:
                way.add(at)
                at -= len(self.token[last[at]])
            shared = way if shared is None else shared & way
        if not shared:
            return last
        cut = max(shared)
        out += self._back(last, cut)
        return last[cut:]


class Pairs:
    """A vectorised hash table from pairs of tokens to a number: open addressing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: int):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask, self.default = np.uint64(64 - bits), (1 << bits) - 1, default
        self.keys, self.values = np.full(1 << bits, FREE, np.uint64), np.full(1 << bits, default, np.int32)
        at = self._first(keys)
        while len(keys):
            free = self.keys[at] == FREE
            self.keys[at[free]] = keys[free]  # of several keys for one place, the last one stays
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys * ODD >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out, at, left = np.full(len(keys), self.default, np.int32), self._first(keys), None
        while True:
            seen = self.keys[at]
            here = seen == keys
            out[here if left is None else left[here]] = self.values[at[here]]
            go = ~here & (seen != FREE)
            if not go.any():
                return out
            left = np.flatnonzero(go) if left is None else left[go]
            keys, at = keys[go], (at[go] + 1) & self.mask


class Batch:
    """The transducer run over many pieces at once, a byte of each at a time.

    Transitions and ending tokens that the machine has built so far are held as arrays with a row for each state;
    unknown ones are asked of the machine. Stability of pairs is kept in a table where a newer pair takes an older
    one's place, and is worked out for all unknown pairs together.
    """

    def __init__(self, machine: Transducer):
        self.machine, most = machine, max(machine.token)
        self.start = most + 1  # stands before a piece
        self.length = np.zeros(most + 2, np.int32)
        for r, b in machine.token.items():
            self.length[r] = len(b)
        merges = {a << 32 | c: r for b, r in machine.ranks.items() for i in range(1, len(b)) if (a := machine.ranks.get(b[:i])) is not None and (c := machine.ranks.get(b[i:])) is not None}
        self.merges = Pairs(np.fromiter(merges, np.uint64, len(merges)), np.fromiter(merges.values(), np.int32, len(merges)), LATE)
        self.known = np.full(1 << KNOWN_BITS, FREE, np.uint64)  # pair << 1 | stable
        self.chain = np.full((2, most + 1), -1, np.int32)
        self.chain_token, self.chain_end, self.chained = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), 0
        self._forget()

    def _forget(self) -> None:
        self.row, self.state = {0: 0}, [0]
        self.moves = np.full((1024, 256), -1, np.int32)
        self.first, self.tokens = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.held = 0

    def _row(self, state: int) -> int:
        row = self.row.get(state)
        if row is None:
            row = self.row[state] = len(self.state)
            self.state.append(state)
            if row >= len(self.moves):
                self.moves = np.concatenate([self.moves, np.full_like(self.moves, -1)])
                self.first = np.concatenate([self.first, self.first])
            ending = [token for token, _ in self.machine._ending(state)]
            while self.held + len(ending) > len(self.tokens):
                self.tokens = np.concatenate([self.tokens, self.tokens])
            self.first[row] = self.held
            self.tokens[self.held : self.held + len(ending)] = ending
            self.held += len(ending)
        return row

    def _move(self, rows: np.ndarray, byte: np.ndarray) -> np.ndarray:
        to = self.moves[rows, byte]
        if (to < 0).any():
            for both in np.unique(rows[to < 0].astype(np.int64) << 8 | byte[to < 0]).tolist():
                target = self._row(self.machine._move(self.state[both >> 8], both & 255))
                self.moves[both >> 8, both & 255] = target
            to = self.moves[rows, byte]
        return to

    def _chains(self, side: int, tokens: np.ndarray) -> np.ndarray:
        """Where the tokens that touch one side of each token begin in the chain arrays, innermost first."""
        at = self.chain[side, tokens]
        if (at < 0).any():
            for token in np.unique(tokens[at < 0]).tolist():
                edge = self.machine._edge(token, side)[::-1]
                while self.chained + len(edge) > len(self.chain_token):
                    self.chain_token, self.chain_end = (np.concatenate([x, x]) for x in (self.chain_token, self.chain_end))
                span = slice(self.chained, self.chained + len(edge))
                self.chain_token[span], self.chain_end[span] = [t for t, _ in edge], [min(e, LATE) for _, e in edge]
                self.chain[side, token] = self.chained
                self.chained += len(edge)
            at = self.chain[side, tokens]
        return at

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses from a to b, for many pairs; the steps are those of Transducer._pair."""
        left, right = self._chains(1, a), self._chains(0, b)
        out, who = np.ones(len(a), bool), np.arange(len(a))
        while len(who):
            x_end, y_end = self.chain_end[left], self.chain_end[right]
            rank = self.merges.get(self.chain_token[left].astype(np.uint64) << np.uint64(32) | self.chain_token[right].astype(np.uint64))
            crossed = (rank < x_end) & (rank <= y_end)
            out[who[crossed]] = False
            go = ~crossed & ((x_end != LATE) | (y_end != LATE))
            pop = x_end <= y_end
            left, right, who = (left + pop)[go], (right + ~pop)[go], who[go]
        return out

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        at = (pair * ODD >> np.uint64(64 - KNOWN_BITS)).astype(np.int64)
        seen = self.known[at]
        out = (seen & np.uint64(1)).astype(bool)
        out[a == self.start] = True
        new = np.flatnonzero((seen >> np.uint64(1) != pair) & (a != self.start))
        if len(new):
            own, first, back = np.unique(pair[new], return_index=True, return_inverse=True)
            good = self._judge(a[new[first]], b[new[first]])
            self.known[at[new[first]]] = own << np.uint64(1) | good.astype(np.uint64)
            out[new] = good[back]
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, longest pieces first, as little-endian 32-bit numbers. No piece is empty."""
        if len(self.state) > ROWS:
            self._forget()
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        begin = np.cumsum(size) - size
        last = np.full((len(size), int(size[0]) + 1), self.start, np.int32)
        state = np.zeros(len(size), np.int32)
        for at in range(1, int(size[0]) + 1):
            n = int(np.searchsorted(-size, -at, side="right"))
            state = self._move(state[:n], data[begin[:n] + at - 1])
            who, k = np.arange(n), self.first[state]
            while len(who):
                token = self.tokens[k]
                good = self._stable(last[who, at - self.length[token]], token)
                last[who[good], at] = token[good]
                who, k = who[~good], k[~good] + 1
        return self._back(last, size)

    def _back(self, last: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Tokens on the way from the ends back to the starts."""
        at, who, path = size.copy(), np.arange(len(size)), []
        while len(who):
            token = last[who, at[who]]
            path.append((who, token))
            at[who] -= self.length[token]
            who = who[at[who] > 0]
        count = np.zeros(len(size), np.int64)
        for who, _ in path:
            count[who] += 1
        end = np.cumsum(count)
        flat = np.zeros(int(end[-1]), "<u4")
        for j, (who, token) in enumerate(path):
            flat[end[who] - 1 - j] = token
        raw = flat.tobytes()
        return [raw[a:b] for a, b in zip(((end - count) * 4).tolist(), (end * 4).tolist())]


class Encoder:
    """encode() many texts: the ids of each as an array. Pieces and units seen lately are kept with their ids."""

    def __init__(self, machine: Transducer, pattern: str):
        self.machine, self.batch, self.split = machine, Batch(machine), regex.compile(pattern).findall
        self.single = pattern == SPACED
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _learn(self, wanted: Iterable[str]) -> None:
        """Adds pieces to the table: tokens as they are, long pieces one by one as a stream, all others together."""
        new = list(set(wanted).difference(self.pieces))
        raw = list(map(str.encode, new))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        token = np.fromiter(map(self.machine.ranks.get, raw, repeat(-1)), np.int64, len(raw))
        whole = np.flatnonzero(token >= 0)
        ids = token[whole].astype("<u4").tobytes()
        self.pieces.update(zip(map(new.__getitem__, whole.tolist()), [ids[i : i + 4] for i in range(0, len(ids), 4)]))
        for i in np.flatnonzero((token < 0) & (size > TOGETHER)).tolist():
            self.pieces[new[i]] = np.array(self.machine.encode(raw[i]), "<u4").tobytes()
        short = np.flatnonzero((token < 0) & (size <= TOGETHER))
        short = short[np.argsort(-size[short], kind="stable")].tolist()
        for k in range(0, len(short), BLOCK):
            block = short[k : k + BLOCK]
            self.pieces.update(zip(map(new.__getitem__, block), self.batch.encode(list(map(raw.__getitem__, block)))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """With the public pattern a piece never goes on from other characters into white space, so single spaces cut
        a text into units that don't depend on each other; else the pattern splits the whole text."""
        if self.single:
            rest = [t.split(" ") for t in texts]
            whole = [units.pop(0) for units in rest]
            unknown = set(chain.from_iterable(rest)).difference(self.units)
            if unsure := {u for u in unknown if not u or u[0].isspace() or u[-1].isspace()}:
                unknown -= unsure
            for i, (first, units) in enumerate(zip(whole, rest)):
                if units and first[-1:].isspace() or unsure and not unsure.isdisjoint(units):
                    whole[i], rest[i] = texts[i], []
        else:
            whole, rest, unknown = texts, [()] * len(texts), ()
        whole = list(map(self.split, whole))
        cut = self.split(" " + " ".join(unknown)) if unknown else []
        self._learn(chain(chain.from_iterable(whole), cut))
        get = self.pieces.__getitem__
        begin = [i for i, p in enumerate(cut) if p[0] == " "]
        ids = list(map(get, cut))
        for u, a, b in zip(unknown, begin, [*begin[1:], len(cut)]):
            self.units[u] = ids[a] if b == a + 1 else b"".join(ids[a:b])
        out = [np.frombuffer(b"".join(chain(map(get, a), map(self.units.__getitem__, b))), "<u4") for a, b in zip(whole, rest)]
        for cache, new, most in ((self.units, unknown, UNITS), (self.pieces, set(chain(cut, *whole)), PIECES)):
            if len(cache) > most:
                cache.clear()
            else:
                for long in [u for u in new if len(u) > UNIT_CHARS]:
                    del cache[long]
        return out


#: States: 0 between characters; 1, 2, 3: so many plain continuation bytes are due; 4 to 7: after E0, ED, F0, F4, whose
#: next byte has a narrower range; 8: not UTF-8.
def _utf8_step(state: int, c: int) -> int:
    if state == 0:
        if c < 0x80:
            return 0
        special = {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}.get(c)
        return special or (1 if 0xC2 <= c <= 0xDF else 2 if 0xE1 <= c <= 0xEF else 3 if 0xF1 <= c <= 0xF3 else 8)
    if state <= 3:
        return state - 1 if 0x80 <= c <= 0xBF else 8
    low, high, to = {4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}.get(state, (1, 0, 8))
    return to if low <= c <= high else 8


class StreamingDecoder:
    """push() ids, get the bytes of the characters that are complete so far; end() gives what is left.

    The UTF-8 machine's state is carried from one push to the next by the bytes of the unfinished character. Bytes
    that can't be UTF-8 are passed on as they are, since decoding must give back the bytes that were encoded.
    """

    def __init__(self, token: dict[int, bytes]):
        self.token, self.kept = token, b""

    def push(self, ids: Iterable[int]) -> bytes:
        raw = self.kept + b"".join(map(self.token.__getitem__, ids))
        cut = start = max(0, len(raw) - 4)
        while start < len(raw) and 0x80 <= raw[start] <= 0xBF:
            start += 1
        state, cut = 0, start
        for i in range(start, len(raw)):
            state = _utf8_step(state, raw[i])
            if state == 8:
                state = _utf8_step(0, raw[i])
                cut = i
                state = 0 if state == 8 else state
            if state == 0:
                cut = i + 1
        cut = len(raw) if state == 0 else cut
        self.kept = raw[cut:]
        return raw[:cut]

    def end(self) -> bytes:
        left, self.kept = self.kept, b""
        return left


#: The tables of this worker, by rank file, and by rank file and pattern; freed when it turns to another operator.
_MACHINES: dict[str, Transducer] = holding({})
_ENCODERS: dict[tuple[str, str], Encoder] = holding({})


def machine(path: str) -> Transducer:
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(read_ranks(path))
    return _MACHINES[path]


def encoder(path: str, pattern: str) -> Encoder:
    release(_MACHINES, _ENCODERS)
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(machine(path), pattern)
    return _ENCODERS[path, pattern]


def encode(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a text, each match of pattern encoded by itself."""
    return encoder(path, pattern).encode([text])[0].tolist()


def decode(ids: list[int], path: str, step: int = 65536) -> bytes:
    """Bytes of ids, decoded in steps of so many ids."""
    decoder = StreamingDecoder(machine(path).token)
    return b"".join([*(decoder.push(ids[i : i + step]) for i in range(0, len(ids), step)), decoder.end()])


def tokenised(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs, and the ids themselves if asked for.

    Null text counts as empty: no tokens, and the digests of no bytes. path is a rank file that every executor has;
    pattern has no groups. Rows are independent of each other, so repeated rows give repeated results.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [str(i) for i in range(encoder(path, pattern).batch.start)]
        for some in gathered(batches, SLICE):
            coder = encoder(path, pattern)
            encoded = iter(coder.encode([t.decode() if t else "" for _, got in some for t in got]))
            for batch, got in some:
                counts, digests, decoded, all_ids = [], [], [], [np.zeros(0, "<u4")]
                for found in islice(encoded, len(got)):
                    ids = found.tolist()
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(decode(ids, path)).hexdigest())
                    if with_ids:
                        all_ids.append(found)
                columns = [batch.column(batch.schema.get_field_index("doc_id")), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                columns += [lists(np.concatenate(all_ids).view(np.int32), counts, pa.int32())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
