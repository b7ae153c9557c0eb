"""churnspark: customer-churn analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames; all row-scale work
runs in Spark with built-in expressions. Fitted state (quantile bounds,
scaler moments, category lists, tree nodes) is small and held as tables or
literals; nothing proportional to the data passes through the driver.
"""

from churnspark.session import get_session, ensure_checkpoint_dir
from churnspark.spec import FrameSpec

__all__ = ["get_session", "ensure_checkpoint_dir", "FrameSpec"]
