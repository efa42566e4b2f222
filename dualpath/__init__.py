"""Two paths over one event stream: a fast provisional one, a corrected one, and their reconciliation."""
