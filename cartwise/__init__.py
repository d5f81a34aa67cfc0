"""cartwise: repurchase and market-basket analytics as lazy Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing is collected to the
driver. The sub-packages are:

- ``sources``   readers/writers, explicit schemas, the test-table adapter, artifacts
- ``functions`` column helpers (time arithmetic, text, checks) and skew-safe prefix sums
- ``operators`` the analytics operators (windows, features, rules, recommend, evaluate, ...)
- ``plans``     named end-to-end queries over the test tables plus their SQL twins
- ``streaming`` the scored request stream
"""

__version__ = "0.1.0"
