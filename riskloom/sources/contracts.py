"""What each raw table is called, which columns are kept and under which name.

A column that no contract names is left out at the scan. Text is never read as
a number unless a contract says so: registration numbers, credit codes and
identity numbers keep their leading zeros.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Header -> short name, shared by all registry tables.
COMMON = {
    "企业名称": "qymc",
    "关联机构设立登记表主键ID": "gljgsldjbzjID",
    "数据状态": "sjzt",
    "数据来源": "sjly",
    "创建时间": "cjsj",
    "创建人ID": "cjrID",
    "信息提供部门编码": "xxtgbmbm",
    "信息提供部门名称": "xxtgbmmc",
    "提供日期": "tgrq",
    "任务编号": "rwbh",
    "组织机构代码": "zzjgdm",
    "工商注册号": "gszch",
    "法定代表人姓名": "fddbrxm",
}

# The folders of the two rounds, in order of precedence, and
# whether a folder belongs to the first round.
TRAIN_FOLDERS = (("chusai/train", 1), ("fusai/train", 0))
TEST_FOLDERS = (("fusai/test", 0),)
BOTH_TEST_FOLDERS = (("chusai/test", 1), ("fusai/test", 0))


@dataclass(frozen=True)
class Contract:
    """One raw table: file stem, own columns and the columns that are numbers."""

    file: str
    columns: dict[str, str] = field(default_factory=dict)
    numbers: tuple[str, ...] = ()
    train: tuple[tuple[str, int], ...] = TRAIN_FOLDERS
    test: tuple[tuple[str, int], ...] = TEST_FOLDERS

    @property
    def names(self) -> dict[str, str]:
        return {**COMMON, **self.columns}


# File names, headers and short names of the raw tables.
CONTRACTS = {
    "base": Contract("企业基本信息&高管信息&投资信息", {
        "注册号": "zch", "统一社会信用代码": "tyshxydm", "注册资金": "zczj", "注册资本(金)币种名称": "zczbbzmc",
        "企业(机构)类型名称": "qyjglxmc", "行业门类代码": "hymldm", "成立日期": "clrq", "核准日期": "hzrq",
        "住所所在地省份": "zsszdsf", "姓名": "xm", "法定代表人标志": "fddbrbz", "首席代表标志": "sxdbbz",
        "职务": "zw", "投资人": "tzr", "出资比例": "czbl",
    }, numbers=("zczj", "czbl")),
    "dishonest": Contract("失信被执行人名单", test=()),
    "punished": Contract("双公示-法人行政处罚信息", test=()),
    "branch": Contract("分支机构信息", {
        "分支机构省份": "fzjgsf", "分支企业名称": "fzqymc", "分支机构状态": "fzjgzt", "分支成立时间": "fzclsj",
        "分支死亡时间": "fzswsj", "分支行业门类": "fzhyml", "分支行业代码": "fzhydm", "分支机构区县": "fzjgqx",
        "分支机构类型": "fzjglx",
    }, numbers=("fzjgsf", "fzjgzt", "fzhydm", "fzjgqx", "fzjglx"), test=BOTH_TEST_FOLDERS),
    "registration": Contract("机构设立（变更）登记信息", {
        "企业类型代码": "qylxdm", "企业类型名称": "qylxmc", "种类": "zl", "法定代表人证件号码": "fddbrzjhm",
        "注册（开办）资金": "zckbzj", "实收资金": "sszj", "经营范围": "jyfw", "所属行业名称": "sshymc",
        "所属行业代码": "sshydm", "机构地址（住所）": "jgdzzs", "发证机关名称": "fzjgmc", "发证日期": "fzrq",
        "（变更）核准日期": "bghzrq", "行政区划": "xzgh", "企业经度": "qyjd", "企业纬度": "qywd",
        "是否有经纬度": "sfyjwd", "企业地址是否有变化": "qydzsfybh",
    }, numbers=("qyjd", "qywd")),
    "revocation": Contract("法人行政许可注（撤、吊）销信息"),
    "honour": Contract("企业表彰荣誉信息"),
    "abnormal": Contract("企业非正常户认定", {
        "税务管理码": "swglm", "纳税人识别号": "nsrsbh", "纳税人状态": "nsrzt", "登记注册类型": "djzclx",
        "注册地址": "zcdz", "认定日期": "rdrq", "应用年限": "yynx", "管理机构": "gljg",
    }, numbers=("yynx",)),
    "tax": Contract("企业税务登记信息", {
        "税务管理码": "swglm", "纳税人识别号": "nsrsbh", "法定代表人证件名称": "fddbrzjmc", "登记注册类型": "djzclx",
        "审核结果": "shjg", "审核时间": "shsj", "审核单位": "shdw", "区域": "qy",
    }),
    "infringement": Contract("双打办打击侵权假冒处罚案件信息", {
        "行政处罚决定书文号": "xzcfjdswh", "被处罚企业统一社会信用编码": "bcfqytyshxybm",
        "被处罚企业工商注册号": "bcfqygszch", "被处罚的企业法定代表人姓名": "bcfdqyfddbrxm",
        "被处罚的企业法定代表人身份证号": "bcfdqyfddbrsfzh", "违反法律、法规或规章的主要事实": "wfflfghgzdzyss",
        "行政处罚的种类和依据": "xzcfdzlhyj", "行政处罚的履行方式和期限": "xzcfdlxfshqx",
        "作出处罚决定的行政执法机关名称": "zccfjddxzzfjgmc", "作出处罚决定的日期": "zccfjddrq",
        "公布方式及网址": "gbfsjwz",
    }),
    "licence": Contract("双公示-法人行政许可信息", {
        "进入业务库的时间": "jrywkdsj", "数据状态_1": "sjzt1", "行政相对人代码_1": "xzxdrdm1",
        "行政相对人代码_2": "xzxdrdm2", "行政相对人代码＿3": "xzxdrdm3", "行政相对人代码＿4": "xzxdrdm4",
        "行政相对人代码＿5": "xzxdrdm5", "许可决定书文号": "xkjdswh", "项目名称": "xmmc", "行政许可编码": "xzxkbm",
        "审批类别": "splb", "许可内容": "xknr", "行政相对人名称": "xzxdrmc", "法定代表人名称": "fddbrmc",
        "许可决定日期": "xkjdrq", "许可截止期": "xkjzq", "许可机关": "xkjg", "数据状态_2": "sjzt2",
        "地方编码": "dfbm", "数据更新时间戳": "sjgxsjc", "信息使用范围": "xysyfw", "公示截止期": "gsjzq",
    }, numbers=("dfbm",)),
    "inspection": Contract("许可资质年检信息", {
        "证书编号": "zsbh", "年检年度": "njnd", "年检结果": "njjg", "年检机关全称": "njjgmc", "年检事项名称": "njsxmc",
        "年检日期": "njrq", "交换单位全称": "jhdwqc",
    }),
    "recruitment": Contract("招聘数据", {
        "网站名称": "wzmc", "工作经验": "gzjy", "工作地点": "gzdd", "职位类别": "zylb", "招聘人数": "zprs",
        "职位月薪": "zwyx", "最低学历": "zdxl", "业务主键": "ywzj", "招聘日期": "zprq",
    }),
    "qualification": Contract("资质登记（变更）信息", {
        "资质证书编号": "zzzsbh", "资质名称": "zzmc", "执业范围": "zyfw", "资质生效期": "zzsxq",
        "资质截止期": "zzjzq", "认定机关全称": "rdjgqc", "认定日期": "rdrq",
    }),
}
