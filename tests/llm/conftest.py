import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Invented sentences, the same ones for the same seed."""

    def make(seed: int, words: int, vocabulary: int = 400) -> str:
        r = random.Random(seed)
        known = random.Random(99)
        stems = ["".join(known.choice("abdeghilmnorstu") for _ in range(known.randint(2, 8))) for _ in range(vocabulary)]
        return " ".join(r.choice(stems) for _ in range(words))

    return make
