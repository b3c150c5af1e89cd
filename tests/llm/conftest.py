import random

import pytest


@pytest.fixture()
def corpus():
    """Random documents with copies, near copies, shared passages, empty and null texts."""
    def make(seed, n=60, length=120):
        rnd = random.Random(seed)
        vocab = ["".join(rnd.choices("abcdefgh", k=rnd.randint(1, 3))) for _ in range(400)]
        vocab += ["Ünï", "X,", "É"]
        passages = [[rnd.choice(vocab) for _ in range(rnd.randint(40, 120))] for _ in range(4)]
        texts = []
        for _ in range(n):
            words = [rnd.choice(vocab) for _ in range(rnd.randint(0, length))]
            kind = rnd.random()
            if texts and kind < 0.15:
                words = texts[rnd.randrange(len(texts))].split()
            elif texts and kind < 0.4:
                words = texts[rnd.randrange(len(texts))].split()
                for _ in range(rnd.randint(1, 4)):
                    if words:
                        words[rnd.randrange(len(words))] = rnd.choice(vocab)
            elif kind < 0.6:
                at = rnd.randint(0, len(words))
                p = rnd.choice(passages)
                words[at:at] = p[rnd.randint(0, 8):len(p) - rnd.randint(0, 8)]
            texts.append("".join(w + rnd.choice([" ", " ", " ", "\n", "\t", " \r\n"]) for w in words))
        rows = list(enumerate(texts))
        rnd.shuffle(rows)
        return [(i * 3, t) for i, t in rows] + [(7, None), (100_001, ""), (100_002, " \n ")]

    return make
