import random
import time

from adloom.llm.suffix_sort import suffix_array


def test_against_plain_sorting():
    rng = random.Random(11)
    texts = [[], [1], [1, 1, 1], [2, 1], [1, 2, 1, 2, 1, 2], [3, 1, 2] * 9 + [3]]
    texts += [rng.choices(range(1, rng.randint(2, 6)), k=rng.randint(1, 60)) for _ in range(3000)]
    texts += [[ord(c) for c in "abaabaaabaaaab" * 7], [1] * 400, [2, 1] * 200 + [2]]
    for text in texts:
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_time_is_linear():
    def took(n, text):
        start = time.process_time()
        suffix_array(text)
        return (time.process_time() - start) / n

    rng = random.Random(2)
    for make in (lambda n: rng.choices(range(1, 9), k=n), lambda n: [1] * n, lambda n: [1, 2] * (n // 2)):
        took(1000, make(1000))
        assert took(200_000, make(200_000)) < 4 * max(took(20_000, make(20_000)), 1e-6)
