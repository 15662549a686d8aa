import pytest
from hypothesis import given, strategies as st

from docindex.locator import Locator, is_locator


@pytest.mark.parametrize("uri, indices, types", [
    ("es://i", ("i",), ()),
    ("es:///i/t", ("i",), ("t",)),
    ("es://i/t/", ("i",), ("t",)),
    ("es://i1,i2/t1,t2", ("i1", "i2"), ("t1", "t2")),
    ("es://first,second,third", ("first", "second", "third"), ()),
])
def test_accepted(uri, indices, types):
    loc = Locator.parse(uri)
    assert (loc.indices, loc.types) == (indices, types)


@pytest.mark.parametrize("uri", ["es://", "es:///", "es://i/t/x", "/p", "hdfs://p", "i/t", "", "es://i//t"])
def test_rejected(uri):
    with pytest.raises(ValueError):
        Locator.parse(uri)


def test_scheme():
    assert is_locator("es://i") and not is_locator("/p") and not is_locator(None)


def test_options_and_defaults():
    loc = Locator.parse("es://i/t?json=true&size=5&q=a%20b&id=f&tasks=3")
    assert [loc.option(n) for n in ("json", "size", "q", "tasks")] == ["true", "5", "a b", "3"]
    assert loc.id_field == "f"
    plain = Locator.parse("es://i/t")
    assert [plain.option(n) for n in ("json", "size", "q", "id", "tasks")] == ["false", "1000", "*", "-1", "100"]
    assert plain.id_field is None
    with pytest.raises(ValueError):
        Locator.parse("es://i/t?colour=red")


def test_scope():
    assert Locator.parse("es://_all").covers("anything", "t")
    assert Locator.parse("es://tweet-2010*").covers("tweet-201004", "t")
    assert not Locator.parse("es://tweet-2010*/u").covers("tweet-201004", "t")
    assert not Locator.parse("es://tweet").covers("tweet-201004", "t")


def test_write_target():
    assert Locator.parse("es://i/t").target == ("i", "t")
    for uri in ("es://i", "es://a,b/t", "es://i/t,u"):
        with pytest.raises(ValueError):
            Locator.parse(uri).target


NAME = st.text("abcdefgh0123_-.", min_size=1, max_size=8)


@given(st.lists(NAME, min_size=1, max_size=4), st.lists(NAME, max_size=3))
def test_round_trip(indices, types):
    uri = "es://" + ",".join(indices) + ("/" + ",".join(types) if types else "")
    loc = Locator.parse(uri)
    assert list(loc.indices) == indices and list(loc.types) == types
