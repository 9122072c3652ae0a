"""Text scans: separators, optional fourth column, quoted personal titles."""

import tempfile

from tastegraph.sources import ratings as R


def _write(text):
    d = tempfile.mkdtemp(prefix="tg-test-")
    path = f"{d}/data.txt"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_separators_give_identical_tables(spark):
    rows = [(1, 10, 5.0, 881250949), (2, 20, 3.0, 891717742), (3, 10, 1.0, 878887116)]
    tab = _write("".join(f"{u}\t{i}\t{int(r)}\t{t}\n" for u, i, r, t in rows))
    colon = _write("".join(f"{u}::{i}::{int(r)}::{t}\n" for u, i, r, t in rows))
    three = _write("".join(f"{u}\t{i}\t{int(r)}\n" for u, i, r, _ in rows))
    expected = sorted((u, i, r) for u, i, r, _ in rows)
    for path, sep in ((tab, "\t"), (colon, "::"), (three, "\t")):
        df = R.read_ratings_text(spark, path, sep)
        assert df.columns == ["user_id", "item_id", "rating"]
        assert sorted(tuple(r) for r in df.collect()) == expected


def test_personal_titles_with_commas(spark):
    path = _write('1,"Boys, Les (1997)",\n2,"Kolya (1996)",5\n')
    personal = R.read_personal(spark, path)
    rows = {r.item_id: (r.title, r.rating) for r in personal.collect()}
    assert rows[1] == ("Boys, Les (1997)", None)
    assert rows[2] == ("Kolya (1996)", 5.0)
    cands = R.personal_candidates(personal).collect()
    assert [(c.user_id, c.item_id, c.title) for c in cands] == [(-1, 1, "Boys, Les (1997)")]
    rated = R.personal_rated(personal).collect()
    assert [(r.user_id, r.item_id, r.rating) for r in rated] == [(-1, 2, 5.0)]


def test_holdout_is_deterministic_and_disjoint(spark):
    from conftest import SF001

    ratings = R.ratings_from_tables(spark, SF001)
    train, test = R.holdout_split(ratings)
    assert (train.count(), test.count()) == (4294, 1088)
    assert train.join(test, ["user_id", "item_id"]).count() == 0
