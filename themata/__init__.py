"""themata: sorting labelled text into categories, as Spark DataFrame operators.

``functions``  Column -> Column helpers (text cleaning, Greek stemming, array maths)
``sources``    reading raw article files and word lists, storing and reloading stages
``operators``  DataFrame -> DataFrame steps (n-grams, term weights, reductions, classifiers)
``plans``      fitted feature models, parameter grids and k-fold runs built from the operators
``streaming``  applying fitted models to a streaming DataFrame
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
