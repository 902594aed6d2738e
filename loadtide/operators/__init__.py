"""DataFrame -> DataFrame operators.

They run no action, but for order statistics (`order.select_ranks` and what uses it), which
need three small counting jobs, and the quality gate, which reads its one-row verdict.
"""
