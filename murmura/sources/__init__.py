"""Tables read and written: feedback, catalogue, canonical store, results."""
