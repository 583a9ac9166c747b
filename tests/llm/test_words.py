import random

import pyarrow as pa

from strandframe.llm import _words


def test_long_rows_read_in_parts_give_the_words_of_short_ones():
    rnd = random.Random(1)
    words = [f"W{rnd.randint(0, 9999)}" if rnd.random() < 0.999 else "Q" * rnd.choice([31, 32, 33, 700_000]) for _ in range(30_000)]
    one = {w: int(_words.word_hashes(w)[0]) for w in {*words, "a", "c", "y" * 1_500_000}}
    for text in (" ".join(words), "\n\t " * 300_000 + " ".join(words) + " " * 700_000, "y" * 1_500_000):
        want = [one[w] for w in text.split()]
        for rows, right in (([text], want), (["a", text, None, "c"], [one["a"], *want, one["c"]])):
            assert [h for w in _words.word_slices(pa.array(rows)) for h in w.hashes.tolist()] == right
