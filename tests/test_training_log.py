import pytest

from claimlens.operators.training import early_stop

# accuracies by epoch -> best epoch, best accuracy, stop epoch, stopped early (patience 2)
CASES = [
    ([0.25, 0.5, 0.75], (3, 0.75, 3, False)),
    ([0.5, 0.25, 0.25, 1.0], (1, 0.5, 3, True)),            # a later peak is never reached
    ([0.5, 0.5, 0.5, 0.9], (1, 0.5, 3, True)),              # equal is no improvement
    ([0.0, 0.0, 0.0], (None, 0.0, 2, True)),                # the best starts at zero
    ([0.0, 0.25], (2, 0.25, 2, False)),
    ([0.25, 0.0, 0.5, 0.25, 0.25, 0.75], (3, 0.5, 5, True)),
    ([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8], (8, 0.8, 8, False)),   # no limit on epochs
    ([0.0], (None, 0.0, 1, False)),
]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame([(run, e + 1, a) for run, (accs, _) in enumerate(CASES) for e, a in enumerate(accs)],
                                 "run long, epoch long, val_acc double")


def test_patience_alone_ends_a_run(log):
    got = {r.run: (r.best_epoch, r.best_val_acc, r.stop_epoch, r.stopped_early) for r in early_stop(log).collect()}
    assert got == {run: want for run, (_, want) in enumerate(CASES)}


def test_a_planned_length_cuts_the_log(log):
    got = {r.run: r.stop_epoch for r in early_stop(log, epochs=5).collect()}
    assert got[6] == 5 and got[0] == 3
