"""Adaptive context-mixing range coder for token ids, in independent checksummed blocks.

Ids are predicted by three models that start empty in every block:

* order 2: the id that last followed the two ids before, and how often in a row that was right;
* order 1: the id that last followed the id before, and how often in a row that was right;
* order 0: how often each id has occurred in the block (refreshed whenever the
  block's length doubles), and a fixed prior that falls with the id for ids
  that have not occurred yet.

Each id is coded as one of four events - the order-2 guess, the order-1 guess, an id
seen in the block, a new id - and for the last two the id itself by its order-0
counts or the prior.  The events' probabilities are a mixture of what the contexts of the three
orders have met in the block (confidence of the order-2 guess, confidence of the
order-1 guess, the event before); counts decay, and the mixture's weights follow the
orders that predicted well.  Counts and weights are brought up to date every
``STRIDE`` ids, guesses with every id.  The probabilities drive a range coder with a 60-bit
window and 32-bit output words.

All arithmetic is on integers, so every machine decodes what another one wrote.
Blocks know nothing of each other.  Encoder and decoder therefore walk many blocks in step:
position t of all blocks at once, as numpy vectors over the blocks, with the same
predict / update code.  Memory is about 70 KB a block in step.

Block layout (little-endian): magic ``TRC1``, vocabulary, ids, words, CRC-32 of the ids
(as 32-bit words), CRC-32 of the payload; then the payload's 32-bit words.
A block with a wrong magic, length or checksum raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from riskspark.llm.textops import _Cache, mix

MAGIC = b"TRC1"
HEADER = "<4sIIIII"
HEADER_SIZE = struct.calcsize(HEADER)
#: ids per block, and blocks walked in step
BLOCK = 2048
LANES = 2048
#: largest vocabulary; order-0 keys are (block, id) with 16 bits for the id
MAX_VOCAB = 1 << 16
SLOT_BITS = 11
EVENT_BITS, PRIOR_BITS, SCALE_BITS = 14, 20, 15
EVENT_TOTAL, SCALE = 1 << EVENT_BITS, 1 << SCALE_BITS
LOW_BITS, WORD_BITS = 28, 32
LOW_MASK, WORD_MASK = (1 << LOW_BITS) - 1, (1 << WORD_BITS) - 1
#: joint contexts of an event: confidence of order 2, confidence of order 1, event before (four values each)
JOINT = 64
#: ids between two updates of the event counts, and counts that stand for a context not met yet
STRIDE, START = 512, np.array([3, 3, 6, 20])
FIRST_REFRESH = 32
#: positions whose order-0 frequencies the encoder looks up at once
STRETCH = 256
_TABLES = _Cache()


def _prior(vocab: int):
    """Cumulative frequencies of new ids: one each, the rest in proportion to 1 / (id + 64)."""
    if ("prior", vocab) not in _TABLES:
        share = (1 << 40) // (np.arange(vocab, dtype=np.int64) + 64)
        freq = 1 + ((1 << PRIOR_BITS) - vocab) * share // int(share.sum())
        freq[0] += (1 << PRIOR_BITS) - int(freq.sum())
        _TABLES["prior", vocab] = np.append(0, np.cumsum(freq))
    return _TABLES["prior", vocab]


def _fresh(name: str, shape, dtype, value):
    """An array kept for the next group of blocks: touching new memory costs more than the work done in it."""
    have = _TABLES.get((name, dtype))
    n = int(np.prod(shape))
    if have is None or len(have) < n:
        have = _TABLES[name, dtype] = np.empty(n, dtype)
    out = have[:n].reshape(shape)
    out[...] = value
    return out


def _hash() -> np.ndarray:
    """A slot for every id and the start mark."""
    if "hash" not in _TABLES:
        x = np.arange(MAX_VOCAB + 1, dtype=np.uint64)
        _TABLES["hash"] = (mix(x) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
    return _TABLES["hash"]


class _Model:
    """Order-1 and order-2 guesses and the mixed event probabilities of ``lanes`` blocks, walked in step."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        self.hash = _hash()
        self.table = _fresh("table", 2 * lanes << SLOT_BITS, "i4", 0)    # (id + 1) << 2 | times right in a row
        self.base = np.stack([lane << SLOT_BITS, (lane + lanes) << SLOT_BITS])
        self.slot = np.empty((2, lanes), np.int64)
        self.before = np.full((2, lanes), self.hash[MAX_VOCAB])          # slots of the last id and the one before it
        self.last = np.full(lanes, 3, np.int64)
        self.row0 = lane * JOINT
        self.joint = np.zeros((lanes, JOINT, 4), np.int64)               # events met, by joint context
        self.weight = np.full((3, lanes), SCALE // 3, np.int64)
        self.rows = np.empty((STRIDE, lanes), np.int32)
        self.events = np.empty((STRIDE, lanes), np.int8)
        self.kept = 0
        self._mix(lanes)

    def _shares(self, a: int):
        """Event probabilities by the contexts of order 2, order 1 and order 0: three (a, JOINT, 4) arrays."""
        j = self.joint[:a].reshape(a, 4, 4, 4, 4)                        # order-2 level, order-1 level, last event, event
        out = []
        for axes in ((2,), (1,), (1, 2)):
            n = j.sum(axis=axes, keepdims=True) + START
            out.append(np.broadcast_to((n << SCALE_BITS) // n.sum(axis=4, keepdims=True), j.shape).reshape(a, JOINT, 4))
        return out

    def _mix(self, a: int):
        self.shares = self._shares(a)
        mixed = sum(p * self.weight[k, :a, None, None] for k, p in enumerate(self.shares)) >> SCALE_BITS
        self.mixed = mixed
        cum = np.cumsum((mixed[:, :, :3] * (EVENT_TOTAL - 64) >> SCALE_BITS) + 1, axis=2)
        #: ends of the four events' intervals, 16 bits each
        self.packed = (cum[:, :, 0] | (cum[:, :, 1] << 16) | (cum[:, :, 2] << 32) | (EVENT_TOTAL << 48)).reshape(-1)

    def learn(self, a: int):
        """Counts and mixture weights from the ids since the last call; then the new mixture of the ``a`` blocks left."""
        rows = self.rows[:self.kept, :a].astype(np.int64) * 4 + self.events[:self.kept, :a]
        new = np.bincount(rows.reshape(-1), minlength=a * JOINT * 4).reshape(a, JOINT, 4)
        gain = np.stack([(new * p[:a] * self.weight[k, :a, None, None] // np.maximum(self.mixed[:a], 1)).sum(axis=(1, 2)) // self.kept
                         for k, p in enumerate(self.shares)])
        w = self.weight[:, :a]
        w += (np.minimum(gain, SCALE) - w) >> 1
        np.maximum(w, SCALE >> 6, out=w)
        w[...] = (w << SCALE_BITS) // w.sum(axis=0)
        self.joint = self.joint[:a] - (self.joint[:a] >> 3) + (new << 4)
        self.kept = 0
        self._mix(a)

    def guess(self, a: int):
        """(guessed ids + 1 of order 2 and order 1, 0 for none; place of the event's probabilities)."""
        hx, slot = self.before[0, :a], self.slot[:, :a]
        np.multiply(hx, 5, out=slot[0])
        slot[0] += self.before[1, :a]
        slot[0] &= (1 << SLOT_BITS) - 1
        slot[1] = hx
        slot += self.base[:, :a]
        self.entry = entry = self.table.take(slot)
        self.level = level = entry & 3
        row = (level[0] << 2) + level[1]
        row <<= 2
        row = row + self.last[:a]
        row += self.row0[:a]
        self.row = row
        return entry >> 2, row

    @staticmethod
    def interval(packed: np.ndarray, event: np.ndarray):
        """Start and length of the events' intervals."""
        shift = event << 4
        low = packed << 16
        low >>= shift
        low &= 0xFFFF
        high = packed >> shift
        high &= 0xFFFF
        high -= low
        return low, high

    def update(self, a: int, ids: np.ndarray, event: np.ndarray, right: np.ndarray):
        more = self.entry + (self.level < 3)
        self.table[self.slot[:, :a]] = np.where(right, more, (ids << 2) + 5)
        self.before[1, :a] = self.before[0, :a]
        self.before[0, :a] = self.hash.take(ids)
        self.last[:a] = event
        self.rows[self.kept, :a], self.events[self.kept, :a] = self.row, event
        self.kept += 1


def _learns(t: int) -> bool:
    """Positions before which the event counts are brought up to date: whenever the length doubles, and every STRIDE ids."""
    return t >= 16 and (t % STRIDE == 0 or t < STRIDE and t & (t - 1) == 0)


class _Seen:
    """Order-0 counts of the first ``size`` ids of ``lanes`` blocks: sorted (block, id) keys with running counts."""

    def __init__(self, ids: np.ndarray):
        size, lanes = ids.shape
        keys = np.sort(((np.arange(lanes, dtype=np.int64) << 16) | ids).reshape(-1))
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.cum, self.size, self.bits = keys[first], np.append(first, len(keys)), size, size.bit_length() - 1

    def find(self, lane, ids):
        """(seen, cumulative count inside the block, count)."""
        key = (lane << 16) | ids
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key, self.cum[at] - lane * self.size, self.cum[at + 1] - self.cum[at]

    def lookup(self, vocab: int):
        """Tables for the decoder: place -> entry, and id, start and length of every entry; new ids first."""
        place, ids, cum, freq = _plain_lookup(vocab)
        count = np.diff(self.cum)
        return (np.concatenate([place, np.repeat(np.arange(vocab, vocab + len(count), dtype=np.int32), count)]),
                np.concatenate([ids, (self.keys & 0xFFFF).astype(np.int32)]),
                np.concatenate([cum, (self.cum[:-1] - (self.keys >> 16) * self.size).astype(np.int32)]),
                np.concatenate([freq, count.astype(np.int32)]))


def _plain_lookup(vocab: int):
    if ("place", vocab) not in _TABLES:
        prior = _prior(vocab)
        freq, ids = np.diff(prior).astype(np.int32), np.arange(vocab, dtype=np.int32)
        _TABLES["place", vocab] = np.repeat(ids, freq), ids, prior[:-1].astype(np.int32), freq
    return _TABLES["place", vocab]


def _refresh(t: int) -> bool:
    return t >= FIRST_REFRESH and t & (t - 1) == 0


def _stretch(t: int) -> int:
    """The end of the positions from t on whose order-0 counts do not change."""
    return max(FIRST_REFRESH, min(2 * t, t + STRETCH))


def _active(sizes: np.ndarray) -> list[int]:
    """How many blocks (longest first) have a position t, for every t."""
    return np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left").tolist()


def _encode_lanes(ids: np.ndarray, sizes: np.ndarray, vocab: int) -> list[np.ndarray]:
    """Payload words of blocks given as columns of ``ids`` (longest first)."""
    lanes, longest = len(sizes), int(sizes[0])
    prior, model = _prior(vocab), _Model(lanes)
    prior_freq = np.diff(prior).astype(np.int32)
    low, width = np.zeros(lanes, np.int64), np.full(lanes, 1 << (LOW_BITS + WORD_BITS), np.int64) - 1
    out = np.zeros((lanes, longest * (EVENT_BITS + PRIOR_BITS) // WORD_BITS + 6), np.int64)
    size = np.zeros(lanes, np.int64)

    def put(at, cum, freq, bits):
        step = width[at] >> bits
        low[at] += step * cum
        step *= freq
        width[at] = step
        short = np.flatnonzero(step < 1 << LOW_BITS)
        if len(short):
            short = short if isinstance(at, slice) else at[short]
            out[short, size[short]] = low[short] >> LOW_BITS
            size[short] += 1
            low[short] = (low[short] & LOW_MASK) << WORD_BITS
            width[short] <<= WORD_BITS

    plan, seen, active = None, None, _active(sizes)
    for t in range(longest):
        a = active[t]
        if _refresh(t):
            seen = _Seen(ids[:t, :a])
        if t % STRETCH == 0 or _refresh(t):              # events and frequencies of the plain part, for a stretch
            part = ids[t:_stretch(t), :a]
            cum, freq = prior[part].astype(np.int32), prior_freq[part]
            bits, plain = np.full(part.shape, PRIOR_BITS, np.int8), np.full(part.shape, 3, np.int8)
            if seen:
                known, c, f = (x.T for x in seen.find(np.arange(a)[:, None], np.ascontiguousarray(part.T)))
                plain[known], bits[known], cum[known], freq[known] = 2, seen.bits, c[known], f[known]
            plan, begin = (plain, cum, freq, bits), t
        x = ids[t, :a]
        if _learns(t):
            model.learn(a)
        guess, row = model.guess(a)
        right = guess == x + 1
        event = np.where(right[0], 0, np.where(right[1], 1, plan[0][t - begin, :a]))
        put(slice(0, a), *model.interval(model.packed.take(row), event), EVENT_BITS)
        at = np.flatnonzero(event >= 2)
        if len(at):
            put(at, *(p[t - begin, at] for p in plan[1:]))
        model.update(a, x, event, right)
    every = np.arange(lanes)
    out[every, size] = low >> LOW_BITS
    out[every, size + 1] = (low & LOW_MASK) << (WORD_BITS - LOW_BITS)
    while (carry := out >> WORD_BITS).any():
        out &= WORD_MASK
        out[:, :-1] += carry[:, 1:]
    return [out[k, :size[k] + 2].astype("<u4") for k in range(lanes)]


def _decode_lanes(words: list[np.ndarray], sizes: np.ndarray, vocab: int) -> np.ndarray:
    """Ids (position, block) of payloads, longest block first."""
    lanes, longest = len(sizes), int(sizes[0])
    lookup, model = _plain_lookup(vocab), _Model(lanes)
    w = np.zeros((lanes, max(map(len, words)) + 3), np.int64)
    for k, x in enumerate(words):
        w[k, :len(x)] = x
    shift = WORD_BITS - LOW_BITS
    ahead = ((w[:, :-1] << LOW_BITS) | (w[:, 1:] >> shift)) & WORD_MASK  # the next 32 bits behind the 60-bit window
    rest = (w[:, 0] << LOW_BITS) | (w[:, 1] >> shift)
    width = np.full(lanes, 1 << (LOW_BITS + WORD_BITS), np.int64) - 1
    at_word = np.ones(lanes, np.int64)
    ids = np.zeros((longest, lanes), np.int64)

    def take(at, step, cum, freq):
        left = rest[at] - step * cum
        step = step * freq
        rest[at], width[at] = left, step
        short = np.flatnonzero(step < 1 << LOW_BITS)
        if len(short):
            short = short if isinstance(at, slice) else at[short]
            if at_word[short].max() >= ahead.shape[1]:
                raise ValueError("token block ends early")
            rest[short] = (rest[short] << WORD_BITS) | ahead[short, at_word[short]]
            width[short] <<= WORD_BITS
            at_word[short] += 1

    seen, active = None, _active(sizes)
    for t in range(longest):
        a = active[t]
        if _refresh(t):
            seen = _Seen(ids[:t, :a])
            lookup = seen.lookup(vocab)
        if _learns(t):
            model.learn(a)
        guess, row = model.guess(a)
        head = slice(0, a)
        step = width[head] >> EVENT_BITS
        place = np.minimum(rest[head] // step, EVENT_TOTAL - 1)
        packed = model.packed.take(row)
        event = (place >= (packed & 0xFFFF)).astype(np.int64)
        event += place >= (packed >> 16 & 0xFFFF)
        event += place >= (packed >> 32 & 0xFFFF)
        take(head, step, *model.interval(packed, event))
        x = np.where(event == 0, guess[0], guess[1]).astype(np.int64) - 1
        at = np.flatnonzero(event >= 2)
        if len(at):
            old = event[at] == 2
            if seen is None and old.any():
                raise ValueError("token block is damaged")
            bits = np.where(old, seen.bits if seen else 0, PRIOR_BITS)
            step = width[at] >> bits
            place = np.minimum(rest[at] // step, (1 << bits) - 1)
            if seen:
                place += np.where(old, (at << seen.bits) + (1 << PRIOR_BITS), 0)
            entry = lookup[0].take(place)
            x[at] = lookup[1].take(entry)
            take(at, step, lookup[2].take(entry), lookup[3].take(entry))
        x = np.maximum(x, 0)                             # only a damaged block takes a guess that is not there
        ids[t, :a] = x
        model.update(a, x, event, guess == x + 1)
    return ids


def _turned(x: np.ndarray) -> np.ndarray:
    """Transposed copy, in tiles that stay in the cache."""
    out = np.empty(x.shape[::-1], x.dtype)
    for i in range(0, x.shape[0], 64):
        for j in range(0, x.shape[1], 64):
            out[j:j + 64, i:i + 64] = x[i:i + 64, j:j + 64].T
    return out


def encode_blocks(blocks: list[np.ndarray], vocab: int) -> list[bytes]:
    """Coded blocks of id arrays (1 to ``BLOCK`` ids below ``vocab`` each), in the same order."""
    if vocab > MAX_VOCAB:
        raise ValueError(f"a vocabulary of {vocab} ids is above {MAX_VOCAB}")
    out: list[bytes] = [b""] * len(blocks)
    for k in range(0, len(blocks), LANES):
        part = blocks[k:k + LANES]
        sizes = np.array([len(x) for x in part], np.int64)
        if sizes.min() < 1 or sizes.max() > BLOCK or max(int(x.max()) for x in part) >= vocab:
            raise ValueError("a block holds 1 to BLOCK ids of the vocabulary")
        order = np.argsort(-sizes, kind="stable")
        ids = np.zeros((len(part), int(sizes.max())), np.int32)
        for lane, b in enumerate(order):
            ids[lane, :sizes[b]] = part[b]
        for b, words in zip(order, _encode_lanes(_turned(ids).astype(np.int64), sizes[order], vocab)):
            payload = words.tobytes()
            out[k + b] = struct.pack(HEADER, MAGIC, vocab, len(part[b]), len(words), zlib.crc32(part[b].astype("<u4").tobytes()),
                                     zlib.crc32(payload)) + payload
    return out


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """Ids of coded blocks as 32-bit arrays; every checksum is tested."""
    out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(blocks)
    for k in range(0, len(blocks), LANES):
        part = []
        for b in blocks[k:k + LANES]:
            if len(b) < HEADER_SIZE:
                raise ValueError("token block ends early")
            magic, vocab, n, m, crc, payload_crc = struct.unpack_from(HEADER, b)
            payload = b[HEADER_SIZE:]
            if magic != MAGIC or len(payload) != 4 * m or not 1 <= n <= BLOCK or zlib.crc32(payload) != payload_crc:
                raise ValueError("token block is damaged")
            part.append((vocab, n, crc, np.frombuffer(payload, "<u4")))
        for vocab in {p[0] for p in part}:
            mine = sorted((i for i, p in enumerate(part) if p[0] == vocab), key=lambda i: -part[i][1])
            ids = _turned(_decode_lanes([part[i][3] for i in mine], np.array([part[i][1] for i in mine], np.int64), vocab).astype(np.int32))
            for lane, i in enumerate(mine):
                x = ids[lane, :part[i][1]].astype("<u4")
                if zlib.crc32(x.tobytes()) != part[i][2]:
                    raise ValueError("token block is damaged: its ids have another checksum")
                out[k + i] = x
    return out
