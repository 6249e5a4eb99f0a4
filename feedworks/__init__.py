"""feedworks: Spark-native feed cleaning, normalisation, keep-first loading and reporting.

Every public function builds a lazy DataFrame / Column; nothing is collected to the
driver.  Sub-packages:

* ``functions``  Column -> Column field cleaners and list parsers (no Python UDFs).
* ``sources``    positional CSV feed reader with arity / corrupt-record rejects, table loader.
* ``operators``  flattening, data-quality split, keep-first upsert, row changes,
                 reports, metrics and sinks.
* ``plans``      composite jobs: the three feed imports and the two query suites.
* ``streaming``  incremental (micro-batch) keep-first feed import.
"""

from feedworks.session import get_session, checkpoint_dir, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
