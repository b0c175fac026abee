"""Estimators configured as the reference's models: Spark ML's own (ML1-ML3, ML8, ML14)
and those of `own` (ML4-ML7, ML9-ML11, ML13, ML15, EN3)."""

from __future__ import annotations

from pyspark.ml import classification as C
from pyspark.ml import regression as R

from . import own as O

MAX_TREE_DEPTH = 30      # Spark's limit; the reference grows trees without a depth limit


def _w(weighted: bool) -> dict:
    return {"weightCol": "weight"} if weighted else {}


def logistic_regression(n_weight: float, C_: float = 1.0, max_iter: int = 1000, weighted: bool = True):
    """ML1: L2 logistic regression; sklearn's C maps to regParam = 1 / (C * n)."""
    return C.LogisticRegression(maxIter=max_iter, regParam=1.0 / (C_ * n_weight), elasticNetParam=0.0,
                                standardization=False, **_w(weighted))


def logistic_together(n_weight: float, C_: float = 1.0, max_iter: int = 1000, weighted: bool = True):
    """ML1 for searches: the settings of a fold are fitted in the same passes."""
    return O.LogisticTogether(maxIter=max_iter, regParam=1.0 / (C_ * n_weight), **_w(weighted))


def linear_svc(n_weight: float, C_: float = 1.0, max_iter: int = 100):
    """ML2: linear SVM (hinge loss; the reference library uses squared hinge)."""
    return C.LinearSVC(maxIter=max_iter, regParam=1.0 / (C_ * n_weight), standardization=False)


def decision_tree(weighted: bool = True, max_depth: int = MAX_TREE_DEPTH, seed: int = 42):
    """ML3: CART tree, balanced class weights."""
    return C.DecisionTreeClassifier(maxDepth=max_depth, seed=seed, maxMemoryInMB=1024, cacheNodeIds=True,
                                    **_w(weighted))


def random_forest(num_trees: int = 200, weighted: bool = True, max_depth: int = MAX_TREE_DEPTH,
                  seed: int = 42, bootstrap: bool = True, subset: str = "sqrt"):
    """ML4 (and EN3 with subset='all'): forest of bootstrapped trees."""
    return O.ForestClassifier(numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy=subset, bootstrap=bootstrap, seed=seed, **_w(weighted))


def bagging_trees(num_trees: int = 100, max_depth: int = MAX_TREE_DEPTH, seed: int = 42):
    """EN3: bagging of full trees = forest with every feature at every split."""
    return random_forest(num_trees, weighted=False, max_depth=max_depth, seed=seed, subset="all")


def gradient_boosting(max_iter: int = 100, step: float = 0.1, max_depth: int = 3, seed: int = 42):
    """ML6: the reference library's defaults (100 stages, rate 0.1, depth 3)."""
    return O.GradientBoostingClassifier(maxIter=max_iter, stepSize=step, maxDepth=max_depth, seed=seed)


def extra_trees(num_trees: int = 300, weighted: bool = True, max_depth: int = 0, groups: int = 10, seed: int = 42):
    """ML5."""
    return O.ExtraTreesClassifier(numTrees=num_trees, maxDepth=max_depth, groups=groups, seed=seed, **_w(weighted))


def adaboost(max_iter: int = 50, step: float = 1.0, seed: int = 42):
    """ML7: the reference library's defaults."""
    return O.AdaBoostClassifier(maxIter=max_iter, stepSize=step, seed=seed)


def lda():
    """ML9."""
    return O.LinearDiscriminant()


def rbf_svc(components: int = 200, max_iter: int = 100, seed: int = 42):
    """ML13."""
    return O.FourierSVC(components=components, maxIter=max_iter, seed=seed)


def lightgbm_like(max_iter: int = 300, step: float = 0.1, num_leaves: int = 31, min_rows: int = 20):
    """ML10: leaf-wise boosting on histograms."""
    return O.LeafwiseBoostingClassifier(maxIter=max_iter, stepSize=step, numLeaves=num_leaves, minRows=min_rows)


def catboost_like(max_iter: int = 300, step: float = 0.1, max_depth: int = 6, cats: list[str] | None = None, key: str | None = None, seed: int = 42):
    """ML11: symmetric trees over numeric features and, with `cats`, raw categorical columns by ordered target statistics."""
    return O.OrderedBoostingClassifier(maxIter=max_iter, stepSize=step, maxDepth=max_depth, catCols=list(cats or []), keyCol=key, seed=seed)


def gaussian_nb():
    """ML8: Gaussian naive Bayes (variance smoothing as in the reference library)."""
    return C.NaiveBayes(modelType="gaussian")


def linear_regression():
    """ML14: ordinary least squares."""
    return R.LinearRegression(regParam=0.0, standardization=False)


def random_forest_regressor(num_trees: int = 100, max_depth: int = 0, groups: int = 4, seed: int = 42):
    """ML15: bootstrapped trees over all features, without a depth limit by default."""
    return O.ForestRegressor(numTrees=num_trees, maxDepth=max_depth, groups=groups, seed=seed)
