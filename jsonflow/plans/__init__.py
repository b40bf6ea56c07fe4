"""Load job specs and the plans made from them."""
