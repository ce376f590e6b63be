"""Adaptive context-mixing arithmetic coding of id sequences, many blocks in step.

Each block is coded alone, from fresh models. Order-1 and order-2 contexts predict
the id that followed them last; how far each prediction is trusted is learned per
length of its run of hits. For one predicted id, the evidence of order 2, order 1 and
order 0 is mixed in the logistic domain with weights that follow the errors, and the
mix drives a binary decision of the coder: is this the id? If no prediction holds,
order 0 codes the id by the counts of the block so far, refreshed at fixed places.
A code begins with the block's distinct ids, so the models need room for those only.

All models are integers, so a decoder on any machine repeats the coder's steps. Numpy
steps through a row of blocks at once, as each id depends on the one before it.

The coder keeps 48 bits: a range between 2^32 and 2^48, renewed by 16 bits at a time.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

PROB_BITS = 16
LIMIT = 1 << PROB_BITS
TABLE_BITS = 12
#: Run lengths of hits that are told apart.
RUNS = 4
RATE = 5
#: Probability of a prediction that a context does not make.
ABSENT = LIMIT // 64
_TOP, _MASK = 1 << 32, (1 << 48) - 1


@functools.cache
def logistic_tables() -> tuple[np.ndarray, np.ndarray]:
    """Integer tables: stretch of a 12-bit probability, squash of a stretched value.

    Values are in 1/256; both are rounded once from plain arithmetic and checked to be
    monotone, as lookups are all that the models may use.
    """
    p = (np.arange(4096) + 0.5) / 4096
    stretch = np.round(np.log(p / (1 - p)) * 256).astype(np.int64)
    x = np.arange(-2047, 2048) / 256
    squash = np.clip(np.round(65536 / (1 + np.exp(-x))), 32, 65504).astype(np.int64)
    return stretch, squash


class Coder:
    """Writes or reads the arithmetic code of a row of blocks.

    ``at`` is a slice or an array of the lanes that a step is for.
    """

    def __init__(self, lanes: int, words: np.ndarray):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, _MASK, np.int64)
        self.used = np.zeros(lanes, np.int64)
        self.words, self.flat, self.width = words, words.reshape(-1), words.shape[1]

    def _renew(self, at: slice | np.ndarray) -> None:
        short = np.flatnonzero(self.range[at] < _TOP)
        if len(short):
            lane = short if isinstance(at, slice) else at[short]
            used = self.used[lane]
            self._shift(lane, lane * self.width + used)
            self.range[lane] <<= 16
            self.used[lane] = used + 1


class Writer(Coder):
    def __init__(self, lanes: int, longest: int):
        super().__init__(lanes, np.zeros((lanes, 3 * longest + 8), np.int32))

    def _shift(self, lane: np.ndarray, place: np.ndarray) -> None:
        low = self.low[lane]
        self.flat[place] = low >> 32
        self.low[lane] = (low & 0xFFFFFFFF) << 16

    def _add(self, at: slice | np.ndarray, what: np.ndarray) -> None:
        """An overflow goes to the word before; finish() passes it on."""
        low = self.low[at] + what
        over = np.flatnonzero(low > _MASK)
        if len(over):
            lane = over if isinstance(at, slice) else at[over]
            self.flat[lane * self.width + self.used[lane] - 1] += 1
            low[over] &= _MASK
        self.low[at] = low

    def bit(self, at: slice | np.ndarray, p: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Code whether something of probability ``p`` / 2^16 holds; no ``p``, no code."""
        own = self.range[at]
        bound = np.where(p > 0, (own >> PROB_BITS) * p, own)
        miss = ~hit & (p > 0)
        self._add(at, bound * miss)
        self.range[at] = np.where(miss, own - bound, bound)
        self._renew(at)
        return hit

    def span(self, at: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        """Code the slots from ``start``, ``width`` of 2^16."""
        unit = self.range[at] >> PROB_BITS
        self._add(at, unit * start)
        self.range[at] = unit * width
        self._renew(at)

    def finish(self) -> list[bytes]:
        """The code of each block, as big-endian words of 16 bits."""
        lane = np.arange(len(self.used))
        for shift in (32, 16, 0):
            self.words[lane, self.used] = self.low >> shift & 0xFFFF
            self.used += 1
        for column in range(int(self.used.max()) - 1, 0, -1):
            self.words[:, column - 1] += self.words[:, column] >> 16
        short = (self.words & 0xFFFF).astype(">u2")
        return [short[i, :n].tobytes() for i, n in enumerate(self.used.tolist())]


class Reader(Coder):
    def __init__(self, codes: list[bytes]):
        words = np.zeros((len(codes), max(map(len, codes)) // 2 + 8), np.int32)
        for i, code in enumerate(codes):
            words[i, : len(code) // 2] = np.frombuffer(code, ">u2")
        super().__init__(len(codes), words)
        first = words[:, :3].astype(np.int64)
        self.code = first[:, 0] << 32 | first[:, 1] << 16 | first[:, 2]
        self.used += 3

    def _shift(self, lane: np.ndarray, place: np.ndarray) -> None:
        self.code[lane] = self.code[lane] << 16 | self.flat[place]

    def bit(self, at: slice | np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether the thing of probability ``p`` holds; false where there is no ``p``."""
        own, code = self.range[at], self.code[at]
        bound = np.where(p > 0, (own >> PROB_BITS) * p, own)
        miss = code >= bound
        self.code[at] = code - bound * miss
        self.range[at] = np.where(miss, own - bound, bound)
        self._renew(at)
        return ~miss & (p > 0)

    def slot(self, at: np.ndarray) -> np.ndarray:
        return np.minimum(self.code[at] // (self.range[at] >> PROB_BITS), LIMIT - 1)

    def span(self, at: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        unit = self.range[at] >> PROB_BITS
        self.code[at] -= unit * start
        self.range[at] = unit * width
        self._renew(at)


class OrderZero:
    """Counts of ids within each block, as spans of 2^16 slots.

    Each id of a block has one slot at least, the rest goes by counts. Spans are
    refreshed when a power of two of ids has passed, from ``FIRST`` on.
    """

    FIRST = 256

    def __init__(self, sizes: np.ndarray):
        """``sizes``: the number of distinct ids of each block."""
        widest = int(sizes.max())
        self.sizes = sizes[:, None]
        self.own = np.arange(widest)
        self.counts = np.zeros((len(sizes), widest), np.uint16)
        self.flat_counts = self.counts.reshape(-1)
        even = (self.own + 1) * LIMIT // self.sizes - 1
        #: Last slot of each id; all that a block lacks end at the last of all.
        self.last = np.minimum(even, LIMIT - 1).astype(np.uint16)

    def refresh(self, seen: int) -> None:
        """Spans by the counts of the ``seen`` ids, a power of two; ended lanes do not matter."""
        total = np.cumsum(self.counts, axis=1, dtype=np.int64)
        total *= LIMIT - self.sizes
        total >>= seen.bit_length() - 1
        total += self.own
        total[self.own >= self.sizes - 1] = LIMIT - 1
        self.last[:] = total

    def span(self, lane: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First slot and number of slots of each id."""
        place = lane * self.last.shape[1] + ids
        flat = self.last.reshape(-1)
        start = flat[place - 1].astype(np.int64) + 1
        start[ids == 0] = 0
        return start, flat[place].astype(np.int64) + 1 - start

    def find(self, lane: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """The id whose span holds the slot, by bisection."""
        size = self.last.shape[1]
        flat, base = self.last.ravel(), lane * size
        low = np.zeros(len(lane), np.int64)
        width = 1 << (size - 1).bit_length()
        slot = slot.astype(np.uint16)
        while width:
            width >>= 1
            probe = low + width
            right = (probe <= size) & (flat[base + np.minimum(probe, size) - 1] < slot)
            low = np.where(right, probe, low)
            if not width:
                break
        return low


class Predictor:
    """For hashed contexts of one order: the last id seen, and its run of hits."""

    def __init__(self, lanes: int, trust: int):
        self.ids = np.full(lanes << TABLE_BITS, -1, np.int16)
        self.run = np.zeros(lanes << TABLE_BITS, np.uint8)
        #: By run length: the probability that the prediction holds.
        self.trust = np.full(lanes * RUNS, trust, np.int64)

    def look(self, lane: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predicted ids, -1 for none, and how far to trust them."""
        self.place = (lane << TABLE_BITS) + (context & ((1 << TABLE_BITS) - 1))
        self.guess = self.ids[self.place].astype(np.int64)
        self.length = self.run[self.place]
        self.row = lane * RUNS + self.length
        self.trusted = self.trust[self.row]
        return self.guess, self.trusted

    def learn(self, ids: np.ndarray) -> None:
        hit = self.guess == ids
        step = (np.where(hit, LIMIT - 1, 0) - self.trusted) >> RATE
        self.trust[self.row] = self.trusted + step * (self.guess >= 0)
        self.run[self.place] = np.where(hit, np.minimum(self.length + 1, RUNS - 1), 0)
        self.ids[self.place] = ids


class Mixer:
    """Weights of three pieces of evidence, in 1/65536, one set for each kind of agreement."""

    KINDS = 4

    def __init__(self, lanes: int):
        self.weights = [np.full(lanes * self.KINDS, 26000, np.int64) for _ in range(3)]
        self.stretch, self.squash = logistic_tables()

    def mix(self, row: np.ndarray, *evidence: np.ndarray) -> np.ndarray:
        """Probability in 2^16 from probabilities in 2^16; ``row`` says which weights."""
        self.row = row
        self.inputs = [self.stretch[p >> 4] for p in evidence]
        self.held = [w[row] for w in self.weights]
        total = sum(w * x for w, x in zip(self.held, self.inputs, strict=True)) >> 16
        self.p = self.squash[np.clip(total, -2047, 2047) + 2047]
        return self.p

    def learn(self, hit: np.ndarray, asked: np.ndarray | bool = True) -> None:
        error = (np.where(hit, LIMIT, 0) - self.p) * asked
        for weights, w, x in zip(self.weights, self.held, self.inputs, strict=True):
            weights[self.row] = w + (x * error >> 12)


def _run(coder: Coder, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> None:
    """Code the columns of ``ids`` or fill them; lanes go from the longest to the shortest.

    Ids are numbers among the distinct ids of their block, ``sizes`` of them.
    """
    reading = isinstance(coder, Reader)
    lanes = len(lengths)
    zero, mixer = OrderZero(sizes), Mixer(lanes)
    width = zero.counts.shape[1]
    one, two = Predictor(lanes, LIMIT // 8), Predictor(lanes, LIMIT // 3)
    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    every = np.arange(lanes)
    living = np.searchsorted(-lengths, -np.arange(len(ids)))
    due = OrderZero.FIRST
    for step in range(len(ids)):
        if step == due:
            zero.refresh(step)
            due *= 2
        live = slice(0, int(living[step]))
        lane, x, y = every[live], last[live], before[live]
        guess1, trust1 = one.look(lane, x * 0x9E3B >> 3 ^ x)
        guess2, trust2 = two.look(lane, x * 0x9E3B ^ y * 0x85EB >> 2 ^ y << 5)
        known1, known2, agree = guess1 >= 0, guess2 >= 0, guess1 == guess2
        # the first question is for the id of order 2, or else of order 1
        guess = np.where(known2, guess2, guess1)
        asked = known1 | known2
        share = zero.span(lane, np.maximum(guess, 0))[1]
        kind = np.where(known2, np.where(agree, 0, 1), 2)
        p = mixer.mix(
            lane * Mixer.KINDS + kind,
            np.where(known2, trust2, ABSENT),
            np.where(agree | ~known2, trust1, ABSENT),
            np.minimum(share, LIMIT - 1),
        )
        p = p * asked
        found = ids[step, live].astype(np.int64)
        hit = coder.bit(live, p) if reading else coder.bit(live, p, found == guess)
        mixer.learn(hit, asked)
        hit &= asked
        if reading:
            found = np.where(hit, guess, found)
        # the second, for the id of order 1 where order 2 was wrong
        at = np.flatnonzero(known1 & known2 & ~agree & ~hit)
        if len(at):
            other = guess1[at]
            p = mixer.mix(
                at * Mixer.KINDS + 3,
                np.full(len(at), ABSENT),
                trust1[at],
                np.minimum(zero.span(at, other)[1], LIMIT - 1),
            )
            again = coder.bit(at, p) if reading else coder.bit(at, p, found[at] == other)
            mixer.learn(again)
            if reading:
                found[at] = np.where(again, other, found[at])
            hit[at] = again
        at = np.flatnonzero(~hit)
        if len(at):
            if reading:
                found[at] = zero.find(at, coder.slot(at))
            coder.span(at, *zero.span(at, found[at]))
        if reading:
            ids[step, live] = found
        zero.flat_counts[lane * width + found] += np.uint16(1)
        one.learn(found)
        two.learn(found)
        before[live], last[live] = x, found


def _longest_first(lengths: list[int]) -> np.ndarray:
    return np.argsort(-np.array(lengths, np.int64), kind="stable")


#: Ids a block may have at most: numbers of ids are 16 bits with a sign.
LONGEST = 1 << 15


def _alphabet(ids: np.ndarray) -> bytes:
    steps = zlib.compress(np.diff(ids, prepend=0).astype("<u4").tobytes(), 6)
    return len(steps).to_bytes(4, "big") + steps


def _read_alphabet(code: bytes) -> tuple[np.ndarray, bytes]:
    end = 4 + int.from_bytes(code[:4], "big")
    return np.cumsum(np.frombuffer(zlib.decompress(code[4:end]), "<u4"), dtype=np.int64), code[end:]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of ids, ``LONGEST`` at most."""
    if not blocks:
        return []
    if max(map(len, blocks)) >= LONGEST:
        raise ValueError(f"a block holds fewer than {LONGEST} ids")
    order = _longest_first([len(b) for b in blocks])
    lengths = np.array([len(blocks[i]) for i in order])
    ids = np.zeros((int(lengths[0]), len(blocks)), np.int32)
    alphabets = []
    for lane, i in enumerate(order):
        known, number = np.unique(blocks[i], return_inverse=True)
        ids[: len(number), lane] = number
        alphabets.append(known)
    coder = Writer(len(blocks), int(lengths[0]))
    _run(coder, ids, lengths, np.array([max(1, len(a)) for a in alphabets]))
    codes = {
        i: _alphabet(known) + code
        for i, known, code in zip(order.tolist(), alphabets, coder.finish(), strict=True)
    }
    return [codes[i] for i in range(len(blocks))]


def decode(codes: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block; ``lengths`` says how many each has."""
    if not codes:
        return []
    order = _longest_first(lengths)
    lane_sizes = np.array(lengths)[order]
    alphabets, rest = zip(*(_read_alphabet(codes[i]) for i in order), strict=True)
    ids = np.zeros((int(lane_sizes[0]), len(codes)), np.int32)
    _run(Reader(list(rest)), ids, lane_sizes, np.array([max(1, len(a)) for a in alphabets]))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(codes)
    for lane, i in enumerate(order.tolist()):
        if lengths[i]:
            out[i] = alphabets[lane][ids[: lengths[i], lane]]
    return out
