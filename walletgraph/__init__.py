"""A PySpark-native engine for UTXO ledgers: shredding, key recovery, wallet clustering and balances."""

from pyspark import cloudpickle

import walletgraph

# Functions that run on executors travel by value, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(walletgraph)
