import pytest

from reclab.plans import contracts


def test_cross_validation_runs_the_iterations_of_the_other_models(spark, monkeypatch):
    asked = {}

    def caught(*args, **options):
        asked.update(options)
        raise StopIteration

    monkeypatch.setattr(contracts.sw, "cross_validate", caught)
    with pytest.raises(StopIteration):
        contracts.cv_contract(spark, "/root/testdata/sf0.001")
    assert asked["max_iter"] == contracts.ITERS
