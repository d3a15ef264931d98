"""Model versions: failed saves, pinned readers, two savers."""

import pytest

from conftest import SF_SMALL
from verso.operators.model import fit_classifier, small_settings
from verso.operators.score import score
from verso.session import scratch_path
from verso.sources import model_store as M
from verso.sources.tables import songs


@pytest.fixture(scope="module")
def models(spark):
    rows = songs(spark, SF_SMALL).select("doc_id", "lyrics", "genre")
    return [fit_classifier(rows, small_settings(vocab_size=n, num_trees=2, max_depth=2, min_df=2.0)) for n in (30, 40)]


def size(model):
    return len(model.stages[1].vocabulary)


def test_latest_and_pinned(spark, models):
    store = scratch_path(spark, "store")
    with pytest.raises(LookupError):
        M.load_version(spark, store)
    assert [M.save_version(m, store, f"n{i}") for i, m in enumerate(models)] == [1, 2]
    assert size(M.load_version(spark, store)) == 40 and size(M.load_version(spark, store, 1)) == 30
    assert [v["note"] for v in M.versions(spark, store).values()] == ["n0", "n1"]
    with pytest.raises(LookupError):
        M.load_version(spark, store, 3)
    rows = songs(spark, SF_SMALL)
    a, b = (sorted(map(str, score(m, rows).collect())) for m in (models[0], M.load_version(spark, store, 1)))
    assert a == b


@pytest.mark.parametrize("step", ["write", "publish"])
def test_failed_save_leaves_the_old_version(spark, models, monkeypatch, step):
    store = scratch_path(spark, "store")
    M.save_version(models[0], store)

    class Half:
        """A model whose save stops half way."""

        def write(self):
            return self

        def save(self, path):
            models[1].stages[0].write().save(f"{path}/stages/0_half")
            raise RuntimeError("stopped")

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if step == "publish":
            m.setattr(M, "_publish", fail)
        with pytest.raises(RuntimeError):
            M.save_version(Half() if step == "write" else models[1], store)
    assert list(M.versions(spark, store)) == [1] and size(M.load_version(spark, store)) == 30
    assert M.save_version(models[1], store) == 2 and size(M.load_version(spark, store)) == 40


def test_two_savers_and_old_versions(spark, models, monkeypatch):
    store = scratch_path(spark, "store")
    M.save_version(models[0], store)
    real = M.versions
    with monkeypatch.context() as m:
        m.setattr(M, "versions", lambda *a: {})  # a saver that saw the store before the other's publish
        assert M.save_version(models[1], store) == 2
    assert list(real(spark, store)) == [1, 2] and size(M.load_version(spark, store, 1)) == 30
    assert M.save_version(models[0], store) == 3
    assert M.drop_versions(spark, store, keep=2) == [1]
    assert list(M.versions(spark, store)) == [2, 3] and size(M.load_version(spark, store, 2)) == 40
    assert M.drop_versions(spark, store, keep=0) == [2] and list(M.versions(spark, store)) == [3]
