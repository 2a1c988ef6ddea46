"""The price model: fit, persist, reload, score the whole mart; patience."""

import pytest

from shelfwise.operators import boosting, model
from shelfwise.operators.joins import materialize
from shelfwise.plans.pipeline import PricingPipeline
from shelfwise.session import run_dir


def test_train_save_load_score(spark, sf_small):
    mart = materialize(PricingPipeline(spark, sf_small).feature_mart)
    fitted, test = model.train(mart, boosting.Params(rounds=4, leaves=8, rate=0.3))
    path = run_dir(spark, "model")
    model.save(fitted, path)
    scored = model.score(model.load(path), mart)
    assert scored.count() == mart.count()
    m = model.regression_metrics(fitted.transform(test)).collect()[0]
    assert m.n > 0 and m.mae >= 0 and m.r2 <= 1.0


@pytest.mark.parametrize("errors, patience, rounds", [
    ([5.0, 4.0, 4.5, 3.0, 3.5, 3.6], 2, 4),      # one bad round isn't the end
    ([5.0, 4.0, 4.5, 4.4, 3.0], 2, 2),           # two are
    ([5.0, 4.0, 4.0, 4.0], 9, 2),                # of equal ones the first
    ([], 3, 0),
])
def test_best_prefix(errors, patience, rounds):
    assert model.best_prefix(errors, patience) == rounds


def test_depth_wise_keeps_the_best_prefix(spark, sf_small):
    mart = materialize(PricingPipeline(spark, sf_small).feature_mart)
    fitted, test, errors = model.train_depth_wise(mart, max_iter=6, patience=30)
    kept = fitted.stages[1]
    assert len(errors) == 6 and kept.getNumTrees == model.best_prefix(errors)
    again = model.prefix(kept, 1)
    assert again.getNumTrees == 1
    assert fitted.transform(test).select("prediction").count() == test.count()
