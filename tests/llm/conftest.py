import pytest


@pytest.fixture
def rows():
    """Rows of a frame as a set-friendly sorted list of tuples."""

    def sorted_rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return sorted_rows


class UnionFind(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


@pytest.fixture
def union_find():
    return UnionFind
