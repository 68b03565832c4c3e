"""Different words that polynomial hashes modulo a power of two take for one, whatever their base."""


def doubled(rounds: int) -> tuple[str, str]:
    one, other = "a", "b"
    for _ in range(rounds):
        one, other = one + other, other + one
    return one, other


#: Two words of 1,024 bytes.
ALIKE = doubled(10)
