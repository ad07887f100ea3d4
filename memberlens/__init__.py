"""memberlens: e-commerce member-profile analytics on Spark DataFrames.

Every public function takes DataFrames (plus plain parameters such as an
``as_of`` date) and returns a lazy DataFrame. Nothing is collected to the
driver; the caller decides when to act (write, count, show, collect).
"""

from memberlens.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
