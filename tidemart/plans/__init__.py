"""The models: conformed tables, history, facts and dimensions."""
