"""Operations of a training-data pipeline, each by one named method.

One module per operator; ``queries`` registers their queries. Nothing outside
this package imports it. Python runs only inside tasks, on Arrow batches; its
code travels with the job, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
