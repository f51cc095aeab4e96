import numpy as np

from tunewright.operators import near_dup


def test_rows_near_the_first_kept_ones_are_found_in_single_precision():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 24)) * 0.1 + np.eye(24)[rng.integers(0, 4, 500)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[5], x[300] = 0, x[3]
    kept = x[:90]
    exact = np.round(x @ kept.T, 9).max(axis=1)
    for t in (0.0, 0.9, float(exact[200]), float(exact[200]) + 1e-9, 1.0):
        far = near_dup.farther(x, kept, kept.astype(np.float32), t)
        assert (far == (exact < t)).all()
