"""vaultmart.functions"""
