"""Small brute-force helpers of the corpus tests."""


def groups(links):
    """node -> smallest node that it is linked with."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


def alnum_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in lower).split(" ")
