import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from helpers_llm import corpus, docs_frame

from quarry.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer():
    odd = ["", "a  b", " a", "a ", "a\n\nb", "a b\nc d\n e", "it's don't", "x\ty", "a b c", "<|endoftext|> x",
           "é́ \U0001F600", "\n", "1,2. 3..", "a\x1cb c", "a, b. c,. d"]
    rng = random.Random(2)
    odd += ["".join(rng.choice("abé 1,.'\n\t s") for _ in range(60)) for _ in range(200)]
    for text, got in zip(odd, packing.encode_texts(odd, PATH)):
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == plain_ids(text), text


@pytest.mark.parametrize("seed", range(20))
def test_plan_uses_every_piece_within_the_length(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 64, 2048])
    counts = {rng.randint(1, cap): rng.randint(1, 40) for _ in range(rng.randint(0, 50))}
    used = Counter()
    for pattern, n in packing.plan_bins(counts, cap):
        assert n > 0 and sum(x * k for x, k in pattern.items()) <= cap
        for x, k in pattern.items():
            used[x] += k * n
    assert used == Counter(counts)


def test_exact_complements_are_consumed():
    bins = packing.plan_bins({10: 2, 7: 3, 3: 3, 5: 1, 4: 1, 1: 1}, 10)
    assert sum(n for _, n in bins) == 6                                  # every sequence full


def check(rows, got, cap):
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1])
    assert set(pieces) == set(texts)
    for key, held in texts.items():
        want = Counter()
        for text in held:
            ids = plain_ids(text) + [0]
            for k, (start, length) in enumerate(packing.cut(len(ids), cap)):
                crc = zlib.crc32(struct.pack(f"<{length}I", *ids[start:start + length]))
                want[(k, start, length, crc)] += 1
        assert want == Counter((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[key])
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end                                         # gapless
            end += length
        assert end <= cap
    return len(sequences)


@pytest.mark.parametrize("cap", [16, 2048])
def test_pack_round_trip(spark, cap):
    rows = corpus()
    got = packing.pack(docs_frame(spark, rows, extra=True).repartition(5), PATH, cap).collect()
    n = check(rows, got, cap)
    assert n <= 1.1 * sum(r.length for r in got) / cap + 2


def test_pack_empty(spark):
    assert packing.pack(docs_frame(spark, []), PATH).count() == 0


def best_fit_count(counts, cap):
    """Sequences of plain best-fit decreasing, piece by piece."""
    import bisect
    rooms = []
    for x in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        at = bisect.bisect_left(rooms, x)
        room = rooms.pop(at) if at < len(rooms) else cap
        if room - x:
            bisect.insort(rooms, room - x)
        else:
            pass
    used = sum(x * n for x, n in counts.items())
    return (used + sum(rooms)) // cap


@pytest.mark.parametrize("kind", ["uniform", "middle", "lognormal", "short"])
def test_never_more_sequences_than_best_fit(kind):
    rng = random.Random(7)
    draw = {"uniform": lambda: rng.randint(1, 2048), "middle": lambda: rng.randint(600, 1400),
            "lognormal": lambda: min(2048, max(1, int(rng.lognormvariate(6, 1)))), "short": lambda: rng.randint(1, 200)}[kind]
    counts = Counter(draw() for _ in range(6000))
    bins = packing.plan_bins(counts, 2048)
    made = sum(n for _, n in bins)
    assert -(-sum(x * n for x, n in counts.items()) // 2048) <= made <= best_fit_count(counts, 2048)
