"""The semantics once more, as slow plain Python that shares nothing with the library."""

from __future__ import annotations


def join_pair(seq, pair, new):
    out = []
    for token in seq:
        out.append(token)
    place = 0
    while place + 1 < len(out):
        if tuple(out[place : place + 2]) == pair:
            out[place : place + 2] = [new]
        place += 1
    return out


def tally(sequences):
    """Pair -> (count, place of first sight)."""
    seen = {}
    clock = 0
    for seq in sequences:
        for pair in zip(seq, seq[1:]):
            count, first = seen.get(pair, (0, clock))
            seen[pair] = (count + 1, first)
            clock += 1
    return seen


def train(sequences, rounds):
    sequences = [list(seq) for seq in sequences]
    record = []
    for number in range(rounds):
        seen = tally(sequences)
        if not seen:
            break
        best = sorted(seen, key=lambda pair: (-seen[pair][0], seen[pair][1]))[0]
        if seen[best][0] == 1:
            break
        record.append((*best, 256 + number, seen[best][0]))
        sequences = [join_pair(seq, best, 256 + number) for seq in sequences]
    return record


def encode(text, merges):
    ranks = {(left, right): token_id for left, right, token_id in merges}
    seq = list(text.encode())
    while True:
        present = [ranks[pair] for pair in zip(seq, seq[1:]) if pair in ranks]
        if not present:
            return seq
        lowest = min(present)
        seq = join_pair(seq, next(p for p, k in ranks.items() if k == lowest), lowest)


def loader(shard_sizes, batch, length, world, rank, steps):
    """(shard, start) of the first ``steps`` batches.  Of a shard's batches of a rank, one is read if it is the first or
    ends before the last token; after the last shard the first follows."""
    size = batch * length
    one_pass = [
        (shard, number * size)
        for shard, tokens in enumerate(shard_sizes)
        for number in range(rank, tokens // size + world, world)
        if number == rank or number * size + size + 1 < tokens
    ]
    return [one_pass[step % len(one_pass)] for step in range(steps)]
