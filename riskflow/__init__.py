"""Event-time payment-risk features as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns), works on batch
and streaming input unless it says otherwise, and never starts a session.
"""
