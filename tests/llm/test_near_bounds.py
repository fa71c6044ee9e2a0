"""The binomial bound that both filters of op4 share."""

from math import comb

from vaultweave.llm import near_dedup


def test_bound_of_the_near_filters():
    for percent in (60, 80, 85, 95):
        need, p = near_dedup.shared_least(percent, near_dedup.K), percent / 100
        tail = lambda t: sum(comb(near_dedup.K, i) * p ** i * (1 - p) ** (near_dedup.K - i) for i in range(t))
        assert tail(need) <= near_dedup.MISS < tail(need + 1)
