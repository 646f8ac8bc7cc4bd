"""Small raw tables for the end-to-end tests, written with the csv module."""

import csv
import random

from riskloom.sources.contracts import CONTRACTS

SCOPES = ["销售：空压机配件、节能产品", "机电设备、模具及配件销售", "软件开发，技术咨询", "餐饮服务", "LED灯具 销售\n及安装"]


def _value(rng, alias):
    day = f"20{rng.randint(10, 18)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    if alias in ("clrq", "hzrq"):
        return f"{day} 00:00:00"
    if alias in ("fzclsj", "fzswsj"):
        return rng.choice(["", f"{rng.randint(2000, 2018)}/{rng.randint(1, 12)}/{rng.randint(1, 28)}"])
    if alias in ("xkjzq", "xkjdrq", "njrq", "zzsxq", "zzjzq"):
        return rng.choice(["", day, f"{day} 13:45:00"])
    if alias in ("fddbrbz", "sxdbbz"):
        return rng.choice(["是", "否", ""])
    if alias == "zsszdsf":
        return rng.choice(["江苏省", "江苏省", "江苏省", "浙江省"])
    if alias == "zprs":
        return rng.choice(["招5-10人", "若干", "", "3人", "１２人"])
    if alias == "jyfw":
        return rng.choice([*SCOPES, ""])
    if alias == "jgdzzs":
        return rng.choice(["苏州市吴中区东山镇", "ab", "", "昆山市玉山镇"])
    if alias == "xzgh":
        return rng.choice(["320506", "320583", "330102"])
    if alias in ("czbl", "zczj", "qyjd", "qywd", "yynx", "dfbm", "fzjgsf", "fzjgzt", "fzhydm", "fzjgqx", "fzjglx"):
        return rng.choice(["", str(rng.randint(1, 500) / 4)])
    if alias in ("zch", "tyshxydm"):
        return f"00{rng.randint(1, 3)}"
    return rng.choice(["", "NaN", f"{alias}{rng.randint(0, 4)}"])


def write(root, enterprises=60, seed=7):
    """Write all tables; returns ``{(table, split): [row, ...]}`` with short names, in file order."""
    rng = random.Random(seed)
    written = {}
    for table, contract in CONTRACTS.items():
        own = contract.columns or {"创建时间": "cjsj", "提供日期": "tgrq"}
        headers = {"企业名称": "qymc", **own}
        if table == "registration":
            headers = {**headers, "数据来源": "sjly", "任务编号": "rwbh", "信息提供部门名称": "xxtgbmmc",
                       "组织机构代码": "zzjgdm", "工商注册号": "gszch"}
        elif table in ("abnormal", "licence", "inspection"):
            headers = {**headers, "任务编号": "rwbh", "信息提供部门名称": "xxtgbmmc", "创建时间": "cjsj"}
        for split, folders in (("train", contract.train), ("test", contract.test)):
            for folder, first in folders:
                path = root / folder
                path.mkdir(parents=True, exist_ok=True)
                names = [f"企业{folder[:1]}{split}{i}" for i in range(enterprises // 2)] \
                    if folder.startswith("chusai") else [f"企业f{split}{i}" for i in range(enterprises)]
                # Some enterprises occur in both rounds.
                shared = [f"企业共{split}{i}" for i in range(8)]
                rows = []
                if table in ("base", "registration"):
                    members = [*names, *shared, *rng.sample(names, len(names) // 2)]
                else:
                    members = [rng.choice([*names, *shared, ""]) for _ in range(enterprises)]
                for name in members:
                    rows.append({alias: name if alias == "qymc" else _value(rng, alias) for alias in headers.values()})
                with open(path / f"{contract.file}.csv", "w", newline="", encoding="utf-8") as handle:
                    out = csv.writer(handle)
                    out.writerow([*headers, "备注"])
                    out.writerows([*row.values(), "x"] for row in rows)
                written.setdefault((table, split), []).extend({**row, "is_chusai": first} for row in rows)
    return written
