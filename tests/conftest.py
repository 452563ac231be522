import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("themata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clusters(spark):
    """Four well separated classes of 60 points in six dimensions."""
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 6, (4, 6))
    rows = []
    for i in range(240):
        label = "abcd"[i % 4]
        rows.append((i, label, (centres[i % 4] + rng.normal(0, 1, 6)).tolist()))
    return spark.createDataFrame(rows, "id long, label string, features array<double>").coalesce(2).cache()


@pytest.fixture(scope="session")
def points(clusters):
    rows = clusters.orderBy("id").collect()
    return np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows])


@pytest.fixture(scope="session")
def corpus(spark):
    """Eight short documents of two classes."""
    texts = [
        (0, "sport", "the ball and the goal, the team won 2.5 points"),
        (1, "sport", "the team lost the ball near the goal"),
        (2, "sport", "goal goal goal for the home team"),
        (3, "sport", "fans of the home team sang"),
        (4, "money", "the bank raised the interest rate"),
        (5, "money", "interest rate of the bank fell, the bank said"),
        (6, "money", "home loans follow the interest rate"),
        (7, "money", "??"),
    ]
    return spark.createDataFrame(texts, "doc_id long, label string, text string").coalesce(2).cache()


@pytest.fixture(scope="session")
def corpus_tokens(corpus):
    from themata.operators.preprocess import preprocess

    return preprocess(corpus).cache()
