"""Words that weak hashes cannot tell apart."""


def thue_morse(n: int) -> tuple[str, str]:
    """Two words of ``2**n`` letters that sums of letters times powers of an odd base modulo 2**64 cannot tell apart."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
