"""Made-up prose for the tests."""

import random

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wise wizards quietly mix a potion "
    "of old herbs and young roots under a pale moon that nobody in the town has ever seen before"
).split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(PROSE) + str(draw.randrange(40)) for _ in range(words))
