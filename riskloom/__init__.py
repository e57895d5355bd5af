"""riskloom — supply-risk analytics as plain Spark DataFrame transforms.

Every operator is a function from DataFrame(s) plus parameters to a
DataFrame; nothing inside an operator triggers an action except sinks,
model training and report verdicts.
"""

from riskloom.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
